"""Lexical search against plain Python, in one block and in many."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest

from dockflow.llm import lexical
from tests.llm import brute
from tests.llm.test_edges import TEXTS, docs  # noqa: F401


def terms(text: str | None) -> list[str]:
    return brute.re.findall(lexical.TERM, (text or "").translate(brute.LOWER))


def searched(rows: list[tuple], items: list[tuple], k: int) -> list[tuple]:
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(terms(text))
    found = [(key, terms(text)) for key, text in rows]
    n_docs, length = sum(bool(t) for _, t in found), sum(len(t) for _, t in found)
    df = Counter(t for _, ts in found for t in set(ts))
    out = []
    for item, mine in wanted.items():
        scored = []
        for key, ts in found:
            tf, score = Counter(ts), 0
            for t in mine & set(tf):
                m = 100 - 50 + 50 * len(ts) * n_docs // length
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m))
            if score > 0:
                scored.append((-score, key is None, key))
        out += [(item, i, key, -s) for i, (s, _, key) in enumerate(sorted(scored)[:k], 1)]
    return out


def shown(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


ITEMS = [(1, "MIT license, mit!"), (2, None), (3, ""), (4, "one TWO ü 日本語 w1"), (4, "three"), (None, "released word"), (5, "absent"), (6, "e the w 2")]


@pytest.mark.parametrize("k, block", [(50, 1 << 21), (2, 1 << 21), (3, 8)])
def test_odd_rows(spark, docs, k, block):  # noqa: F811
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = lexical.search(docs, items, k=k, block_bytes=block).collect()
    assert shown(got) == shown(searched(TEXTS, ITEMS, k))
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(docs, items.where("text is null or text = ''")).columns == ["item_id", "rank", "doc_id", "score"]


def test_ties_and_many_batches(spark, monkeypatch):
    monkeypatch.setattr(lexical, "CELLS", 12)  # three documents at once
    monkeypatch.setattr(lexical, "PRODUCTS", 5)
    random.seed(2)
    words = [f"t{i}" for i in range(30)]
    rows = [(i, " ".join(random.choices(words, k=random.randint(0, 40)))) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 420)]  # equal scores, more than k
    items = [(i, " ".join(random.choices(words, k=6))) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = lexical.search(df, spark.createDataFrame(items, "item_id long, text string"), k=50).collect()
    assert shown(got) == shown(searched(rows, items, 50))


def test_only_whole_terms_match(spark):
    texts = [(1, "art artist smart"), (2, "ART-art"), (3, "xart artx")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    hits = {r["_key"]: r for r in lexical.scan(df, ["art", "artist"]).collect()}
    assert {k: (r["n"], dict(zip(r["terms"], r["tf"]))) for k, r in hits.items()} == {1: (3, {0: 1, 1: 1}), 2: (2, {0: 2}), 3: (2, {})}
