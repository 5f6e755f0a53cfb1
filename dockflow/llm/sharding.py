"""Shards of near equal bytes by Karmarkar-Karp differencing, equal texts kept together.

Texts that are equal form a group, which is never divided. Groups below a grain of the total are bundled by
hash, larger ones stand alone, so that there is a bounded number of pieces however many documents there are. Each
piece starts as a partition of its own with all but one part empty; the two partial partitions with the
largest spread are combined again and again, the largest part of one with the smallest of the other, until one is left.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.base import written
from dockflow.operators.numbering import row_numbers

SHARDS = 16
#: Bundles per shard; a group as large as a mean bundle is a piece of its own, so there are at most as many of those.
BUNDLES = 1024


def differencing(sizes: list[int], parts: int) -> np.ndarray:
    """Part of every piece; parts are numbered from the largest sum to the smallest."""
    parent = [-1] * len(sizes)
    heap = []
    for i, size in enumerate(sizes):
        heap.append((-size if parts > 1 else 0, i, [size] + [0] * (parts - 1), [i] + [-1] * (parts - 1)))
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a, left = heapq.heappop(heap)
        _, _, b, right = heapq.heappop(heap)
        joined = []
        for s, t, u, v in zip(a, reversed(b), left, reversed(right)):
            if u >= 0 and v >= 0:
                parent[u] = parent[v] = len(parent)
                u = len(parent)
                parent.append(-1)
            joined.append((s + t, max(u, v)))
        joined.sort(reverse=True)
        sums, nodes = map(list, zip(*joined))
        heapq.heappush(heap, (sums[-1] - sums[0], serial, sums, nodes))
        serial += 1
    part = [0] * len(parent)
    if heap:
        for number, node in enumerate(heap[0][3]):
            if node >= 0:
                part[node] = number
    for node in range(len(parent) - 1, -1, -1):
        if parent[node] >= 0:
            part[node] = part[parent[node]]
    return np.array(part[: len(sizes)], np.int64)


def group_of(text: str) -> Column:
    """Equal texts have equal groups; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _bundle(group: str, bundles: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("bundle"), group), F.lit(bundles))


def plan(rows: DataFrame, shards: int = SHARDS, bundles: int = BUNDLES) -> DataFrame:
    """Pieces and their shards: rows ``(alone, id, shard)`` for rows ``(_group, size)``.

    At most ``shards * bundles`` bundles and as many single groups, which the driver divides. Sizes are
    summed by group before they are shuffled, so a text with very many copies is one row.
    """
    spark, count = rows.sparkSession, shards * bundles
    groups = written(rows.groupBy("_group").agg(F.sum("size").alias("bytes")), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    alone = F.col("bytes") * count >= total
    pieces = groups.groupBy(
        alone.alias("alone"), F.when(alone, F.col("_group")).otherwise(_bundle("_group", count)).alias("id")
    ).agg(F.sum("bytes").alias("bytes"))
    found = sorted(pieces.collect(), key=lambda r: (-r["bytes"], r["alone"], r["id"]))
    where = differencing([r["bytes"] for r in found], shards).tolist()
    made = [(r["alone"], r["id"], s) for r, s in zip(found, where)]
    return written(spark.createDataFrame(made, "alone boolean, id long, shard int"), "plan")


def assigned(rows: DataFrame, pieces: DataFrame, shards: int = SHARDS, bundles: int = BUNDLES) -> DataFrame:
    """``rows`` (with ``_group``) and their ``shard``; two joins with small tables of known size."""
    single = pieces.where("alone").select(F.col("id").alias("_group"), F.col("shard").alias("_single"))
    bundle = pieces.where("not alone").select(F.col("id").alias("_bundle"), F.col("shard").alias("_common"))
    out = rows.withColumn("_bundle", _bundle("_group", shards * bundles))
    out = out.join(single, "_group", "left").join(bundle, "_bundle", "left")
    return out.withColumn("shard", F.coalesce("_single", "_common")).drop("_single", "_common", "_bundle")


def shard_slots(
    df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, bundles: int = BUNDLES
) -> DataFrame:
    """One row ``(key, size, text_crc32, shard, slot)`` per row of ``df``.

    ``size`` is the text's UTF-8 bytes plus 1 (null: 1, like an empty text). Bytes per shard are as equal as groups
    of equal texts allow: a group above a shard's share fills one alone. Slots count from 0 in every shard,
    without gaps, by key (nulls last, repeated keys in any order). An empty table gives no rows. Texts are read
    once and not shuffled; slots come from ranges of (shard, key), so no task holds a shard.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    slim = written(
        df.select(
            F.col(f"`{key}`").alias("_key"), (F.octet_length(content) + F.lit(1)).cast("long").alias("size"),
            F.crc32(content.cast("binary")).alias("text_crc32"), group_of(f"`{text}`").alias("_group"),
        ),
        "sizes",
    )
    placed = assigned(slim, plan(slim, shards, bundles), shards, bundles).drop("_group")
    numbered = row_numbers(placed, [F.asc_nulls_last("_key")], "slot", by=["shard"])
    return numbered.select(F.col("_key").alias(key), "size", "text_crc32", "shard", (F.col("slot") - 1).alias("slot"))


def write_shards(
    df: DataFrame, path: str, text: str = "text", shards: int = SHARDS, bundles: int = BUNDLES
) -> None:
    """The rows of ``df`` as Parquet, one folder ``__shard=n`` per shard that has rows; texts are not shuffled."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    grouped = df.select(row, group_of(f"`{text}`").alias("_group"), (F.octet_length(content) + F.lit(1)).cast("long").alias("size"))
    pieces = plan(grouped.select("_group", "size"), shards, bundles)
    out = assigned(grouped.drop("size"), pieces, shards, bundles)
    out.select("_row.*", F.col("shard").alias("__shard")).write.partitionBy("__shard").parquet(path)
