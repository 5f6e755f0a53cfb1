"""Scratch tables in the cluster's shared folder: a plan's rows written once and read from there."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from dockflow.session import ensure_checkpoint_dir
from dockflow.sources.files import delete

_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which driver and executors share."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a scratch table and read from there.

    The plan before it runs once, however often the result is read, and a lost executor costs a read. The
    table has a known size, so Catalyst chooses joins with it by size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, columns: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Like :func:`staged`, in hash buckets of ``columns``: grouping and joining by them needs no shuffle.

    As many buckets as shuffle partitions unless given. The files lie in the scratch folder; the catalog
    entry, which bucketing needs, goes at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    entry = f"{name}_{uuid.uuid4().hex}"
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(count, *columns).write.format("parquet").option("path", path)
    writer.bucketBy(count, *columns).saveAsTable(entry)
    out = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")
    return out


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables made inside the block when it ends.

    Frames are lazy: write what is to be kept before the block ends, under a path made outside it.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete(spark, path)
