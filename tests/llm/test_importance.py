"""Importance resampling: CRC matrices against zlib, results against plain Python."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from dockflow.llm import importance
from tests.llm import brute
from tests.llm.test_edges import TEXTS, docs  # noqa: F401

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def features(text: str | None) -> list[str]:
    w = brute.re.findall(WORD, (text or "").translate(brute.LOWER))
    return [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def buckets(text: str | None, n: int = 10_000) -> Counter:
    return Counter(zlib.crc32(f.encode()) % n for f in features(text))


def resampled(rows: list[tuple], target: list, percent: int = 5, least: int = 20) -> list[tuple]:
    """(key, n_features, weight, score, rank) in the order of ``rows``."""
    own, wanted = Counter(), Counter()
    for _, text in rows:
        own += buckets(text)
    for text in target:
        wanted += buckets(text)
    s, t = own.total() + 10_000, wanted.total() + 10_000
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * s / ((own[b] + 1) * t))) for b in range(10_000)]
    out = []
    for key, text in rows:
        h = int(brute.sha(f"42:{'' if key is None else key}")[:8], 16)
        weight = sum(n * gain[b] for b, n in buckets(text).items())
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(features(text)), weight, score, None])
    fit = [r for r, (_, text) in zip(out, rows) if len(brute.re.findall(WORD, (text or "").translate(brute.LOWER))) >= least]
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(fit[: percent * len(fit) // 100], 1):
        r[4] = rank
    return [tuple(r) for r in out]


def ordered(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, v or 0) for v in r))


@pytest.mark.parametrize("chunk", [3, 50, 1 << 17])
def test_features_and_crcs(monkeypatch, chunk):
    monkeypatch.setattr(importance, "CHUNK_WORDS", chunk)
    random.seed(0)
    texts = ["", "a", "a B", "A b, a-b\0c  9 ü日本", "x" * 3000 + " y " + "z" * 1025, *[t or "" for _, t in TEXTS[:1]]]
    texts += [" ".join(random.choice(["ab", "é", "zz9", "-"]) for _ in range(60)) for _ in range(20)]
    got = [Counter() for _ in texts]
    for owner, bucket in importance.feature_buckets([t.encode() for t in texts], 10_000):
        for i, b in zip(owner.tolist(), bucket.tolist()):
            got[i][b] += 1
    assert got == [buckets(t) for t in texts]


def test_crc_of_slices():
    data = np.random.default_rng(1).integers(0, 256, 9000).astype(np.uint8)
    at = np.array([0, 5, 5, 17, 0, 3, 800])
    size = np.array([1, 1, 700, 1024, 9000, 1025, 5000])
    want = [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(at, size)]
    assert importance.crc32_slices(data, at, size).tolist() == want


def test_odd_rows(spark, docs):  # noqa: F811
    target = spark.createDataFrame([("released under the mit license",), (None,), ("eleven twelve",)], "text string")
    for percent, least in ((5, 20), (50, 1), (100, 0)):
        got = importance.resample(docs, target, percent=percent, least_words=least).collect()
        want = resampled(TEXTS, [r["text"] for r in target.collect()], percent, least)
        assert ordered(got) == ordered(want)
    assert importance.resample(docs.limit(0), target).count() == 0
    alone = importance.resample(docs, target.limit(0), percent=50).collect()
    assert ordered(alone) == ordered(resampled(TEXTS, [], 50))


def test_equal_scores_go_to_the_smaller_key(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(importance, "noise", lambda key, seed: F.lit(0))
    df = spark.createDataFrame([(k, "same words " * 20) for k in (5, 3, 9, 1, None, 3)], "doc_id long, text string")
    got = importance.resample(df, df, percent=100).collect()
    places = sorted((r["rank"], r["doc_id"]) for r in got)
    assert [k for _, k in places] == [1, 3, 3, 5, 9, None]
