"""Paths on whatever file system holds them, through Hadoop's interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path and all below it; nothing happens where it is absent."""
    system, where = _at(spark, path)
    system.delete(where, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a path to another that is absent, making the folders above it."""
    system, where = _at(spark, old)
    target = _at(spark, new)[1]
    system.mkdirs(target.getParent())
    if not system.rename(where, target):
        raise OSError(f"cannot rename {old} to {new}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none where it is absent."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return []
    return [s.getPath().getName() for s in system.listStatus(where)]
