"""Shards: differencing against a plain version, laws of the query, odd rows."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pyarrow.dataset as ds
import pytest

from dockflow.llm import sharding
from dockflow.llm.queries import QUERIES
from tests.llm.test_edges import TEXTS, docs  # noqa: F401

SF_DIR = "/root/testdata/sf0.1"


def plain_differencing(sizes: list[int], parts: int) -> list[int]:
    """Sums of the parts; partial partitions as sorted lists, the widest two combined each time."""
    lists = [sorted([s] + [0] * (parts - 1)) for s in sizes]
    while len(lists) > 1:
        lists.sort(key=lambda x: x[-1] - x[0])
        a, b = lists.pop(), lists.pop()
        lists.append(sorted(s + t for s, t in zip(a, reversed(b))))
    return lists[0] if lists else [0] * parts


@pytest.mark.parametrize("parts", [1, 2, 3, 16])
def test_differencing(parts):
    random.seed(parts)
    for n in (0, 1, 2, 5, 40, 300):
        sizes = random.sample(range(1, 100_000), n)  # no ties, so the order of combining is fixed
        where = sharding.differencing(sizes, parts)
        sums = [sum(s for s, w in zip(sizes, where) if w == p) for p in range(parts)]
        if n < 6 or parts == 2:
            assert sorted(sums) == plain_differencing(sizes, parts)
        assert sum(sums) == sum(sizes) and len(where) == n
        if n == 300 and parts > 1:
            assert max(sums) - min(sums) < 0.01 * sum(sizes) / parts


def laws(rows: list, texts: dict, shards: int) -> dict[int, int]:
    """Sums of bytes per shard, after the laws that hold for every result."""
    slots, sums, homes = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        assert 0 <= r["shard"] < shards
        slots[r["shard"]].append((r["slot"], r["doc_id"]))
        sums[r["shard"]] += r["size"]
        homes[data].add(r["shard"])
    for found in slots.values():
        assert [s for s, _ in sorted(found)] == list(range(len(found)))
    assert all(len(h) == 1 for h in homes.values())
    return sums


def test_query(spark):
    table = ds.dataset(f"{SF_DIR}/documents.parquet").to_table(["doc_id", "text"]).to_pylist()
    texts = {r["doc_id"]: r["text"] for r in table}
    rows = QUERIES["op13_kk_shards"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}
    sums = laws(rows, texts, 16)
    assert len(sums) == 16 and max(sums.values()) - min(sums.values()) <= 0.001 * sum(sums.values()) / 16
    by_shard = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["slot"]):
        by_shard[r["shard"]].append(r["doc_id"])
    assert all(ids == sorted(ids) for ids in by_shard.values())
    again = QUERIES["op13_kk_shards"](spark, SF_DIR).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_a_group_above_a_share_fills_one_shard(spark):
    random.seed(5)
    rows = [(i, "copy " * 50) for i in range(600)] + [(i, "w " * random.randint(1, 60)) for i in range(600, 2000)]
    texts = dict(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    sums = laws(sharding.shard_slots(df, shards=8).collect(), texts, 8)
    largest = max(sums.values())
    assert largest == 600 * 251
    rest = sorted(sums.values())[:-1]
    assert rest[-1] - rest[0] < 0.1 * rest[-1]  # 60 different texts at most, so no finer


def test_odd_rows(spark, docs, tmp_path):  # noqa: F811
    rows = sharding.shard_slots(docs, shards=3).collect()
    assert len(rows) == len(TEXTS)
    sizes = sorted(len((t or "").encode()) + 1 for _, t in TEXTS)
    assert sorted(r["size"] for r in rows) == sizes
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    copies = {r["shard"] for r in rows if r["doc_id"] in (1, 6)}
    assert len(copies) == 1
    assert sharding.shard_slots(docs.limit(0)).count() == 0
    sharding.write_shards(docs, str(tmp_path / "out"), shards=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.drop("__shard").exceptAll(docs).count() == 0 and back.count() == len(TEXTS)
    homes = back.select("row", "__shard").collect()
    assert {r["__shard"] for r in homes if TEXTS[r["row"]][1] == TEXTS[0][1]} == copies
