"""Scratch tables in the cluster's shared folder, and connected components on them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.sources.scratch import scratch_path, staged

#: A-Z to a-z and nothing else.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a scratch table and read from there.

    Cuts the lineage like a checkpoint: a lost executor costs a read, not the work before it. Unlike
    a checkpoint the table has a known size, so Catalyst can choose a broadcast by that size.
    """
    return staged(df, name)


def text_batches(spark: SparkSession, rows: int = 500) -> None:
    """Let Python get whole texts in small batches; Spark's usual 10,000 rows may be gigabytes of them."""
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(limit)) <= rows:
        spark.conf.set(limit, str(rows))


def number_batches(spark: SparkSession, rows: int = 10_000) -> None:
    """Back to large batches, for steps that hand numbers to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def bucketed(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """Like :func:`written`, in ``buckets`` hash buckets of ``column``: grouping by it needs no shuffle.

    The files lie in the scratch folder; the catalog entry, which bucketing needs, goes at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    entry = f"{name}_{uuid.uuid4().hex}"
    df.write.format("parquet").option("path", path).bucketBy(buckets, column).saveAsTable(entry)
    out = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")
    return out


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an edge list ``(u, v)`` of longs: rows ``(node, component)``.

    Alternates large-star and small-star until the edges are stars around each component's
    smallest node; the number of rounds grows with the logarithm of the longest path. Minima are
    summed up before the shuffle and written first, so the join with a node of very many edges is
    a broadcast by size or a sort-merge join that AQE can split. Nodes without an edge to another
    node, and edges with a null, do not appear.
    """
    e = written(
        edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    before = None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                e.select("v", "v").distinct()
            )
        before = state
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = written(
            both.where("v > u").join(written(least, "least"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "large",
        )
        least = written(e.groupBy("u").agg(F.min("v").alias("m")), "least")
        e = written(
            e.join(least, "u").select(F.explode(F.array(
                F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            )).alias("x")).select("x.*").where("u != v").distinct(),
            "small",
        )
