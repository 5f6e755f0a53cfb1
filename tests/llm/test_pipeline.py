"""The pipeline's stages, each on what the one before kept, against plain Python."""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow.dataset as ds
import pytest

import corpus_pipeline as p
from dockflow.llm import base, secret_scan
from tests.llm import brute
from tests.llm.test_edges import TEXTS, docs  # noqa: F401

SF_DIR = "/root/testdata/sf0.01"


def rows(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def test_stages(spark):
    source = base.table(spark, SF_DIR, "documents")
    columns, now, kept = source.columns, source, {}
    for name, stage in p.STAGES:
        now = base.written(stage(spark, now, SF_DIR), name)
        kept[name] = rows(now)
        if name != p.STAGES[-1][0]:
            assert now.columns == columns
    given = {r["doc_id"]: r for r in rows(source)}

    clean = kept["toxicity"]
    assert all(given[r["doc_id"]] == r for r in clean)
    labels = {r["doc_id"]: r["toxic"] for r in ds.dataset(f"{SF_DIR}/labels.parquet").to_table().to_pylist()}
    ids = {r["doc_id"] for r in clean}
    assert sum(1 for k, t in labels.items() if not t and k not in ids) <= 0.01 * len(labels)
    assert sum(1 for k, t in labels.items() if t and k not in ids) >= 0.5 * sum(labels.values())

    prints = [brute.simhash(r["text"]) for r in clean]
    keys = [r["doc_id"] for r in clean]
    single = kept["simhash_near_dedup"]
    left = {r["doc_id"] for r in single}
    assert len(left) == len(single) and left == set(brute.simhash_components(keys, prints, 3))
    assert all(given[r["doc_id"]] == r for r in single)

    redacted = {r["doc_id"]: r for r in kept["secret_scan"]}
    assert set(redacted) == left
    for r in single:
        text, base_spans = r["text"], brute.base_secrets(r["text"])
        new = redacted[r["doc_id"]]
        assert (new["text"] == text) if not base_spans else "[SECRET]" in new["text"]
        assert not brute.base_secrets(new["text"]) and new["n_chars"] == len(new["text"])

    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    copies = Counter(r["doc_id"] for r in kept["mix_sources"])
    assert max(copies.values()) <= 2
    for r in redacted.values():
        n = brute.words(r["text"])
        sizes[r["source"]] += n
        taken[r["source"]] += n * copies[r["doc_id"]]
        largest[r["source"]] = max(largest[r["source"]], n)
    for s, target in brute.targets(sizes).items():
        assert abs(taken[s] - target) <= largest[s] / 2 + 1
    assert all(redacted[r["doc_id"]] == r for r in kept["mix_sources"])

    encoding = brute.tiktoken_encoding()
    tokens = kept["byte_bpe"]
    assert Counter(r["doc_id"] for r in tokens) == copies
    for r in tokens:
        text = redacted[r["doc_id"]]["text"]
        assert r["ids"] == encoding.encode_ordinary(text) and r["decoded_sha256"] == brute.sha(text)


@pytest.mark.parametrize("name, stage", p.STAGES)
def test_stage_on_odd_rows(spark, docs, name, stage):  # noqa: F811
    out = stage(spark, docs, SF_DIR)
    empty = stage(spark, docs.limit(0), SF_DIR)
    assert empty.count() == 0
    if name != "byte_bpe":
        assert out.columns == docs.columns == empty.columns
    found = rows(out)
    if name in ("toxicity", "secret_scan", "byte_bpe"):
        assert len(found) == len(TEXTS)
    if name == "secret_scan":
        assert all(not secret_scan.base_spans(r["text"] or "") for r in found)
