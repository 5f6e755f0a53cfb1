"""Fingerprints of texts that hold no closed syncmer."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from dockflow.llm import syncmers
from tests.llm import brute


def test_short_texts_have_fingerprints_of_their_own(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    texts = [" ".join(word() for _ in range(n)) for n in range(1, 15) for _ in range(12)]
    bare = [t for t in texts if len(t.split()) < 8 or len(brute.syncmers(t)) == 1]
    texts += ["!!!", "?!", "…", "", "  \n", None]
    df = spark.createDataFrame(list(enumerate(texts)), "row int, text string")
    df = syncmers.anchors(df.withColumn("_h", syncmers.token_hashes(F.col("text"))), "_h", "anchors")
    got = {r["row"]: [a["hash"] for a in r["anchors"]] for r in df.collect()}
    for i, text in enumerate(texts):
        assert got[i] == brute.syncmers(text or "")
    alone = [got[i] for i, t in enumerate(texts[:-6]) if t in bare] + [got[len(texts) - i] for i in (4, 5, 6)]
    assert all(len(x) == 1 for x in alone) and len(set(map(tuple, alone))) == len(alone)
    assert [got[len(texts) - i] for i in (1, 2, 3)] == [[], [], []]
    pair = spark.range(1).select(
        syncmers.likeness(*(F.array(*map(F.lit, x)) for x in alone[:2])).alias("other"),
        syncmers.likeness(*(F.array(*map(F.lit, alone[0])) for _ in "ab")).alias("same"),
    ).first()
    assert (pair["other"], pair["same"]) == (0.0, 1.0)
