"""Sinks: day partitions, CSV with JSON cells, sample batches, split sets, feature types."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockflow.functions.keys import day_text
from dockflow.sources import files
from dockflow.sources.scratch import scratch_scope, staged


def create_day_table(
    spark: SparkSession,
    name: str,
    columns: Sequence[tuple[str, str, str]],
    comment: str = "",
    day_column: str = "pt",
    fmt: str = "parquet",
) -> None:
    """Declare a table of ``(name, type, comment)`` columns, partitioned by a string day."""
    text = lambda s: s.replace("\\", "\\\\").replace("'", "\\'")
    body = ", ".join(f"`{n}` {t} COMMENT '{text(c)}'" for n, t, c in columns)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({body}, `{day_column}` STRING) USING {fmt} "
        f"PARTITIONED BY (`{day_column}`) COMMENT '{text(comment)}'"
    )


def _sorted(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows in order within each file, so that row groups cover narrow ranges."""
    return df.sortWithinPartitions(*order) if order else df


def overwrite_day(
    df: DataFrame, day: date | str, path: str, day_column: str = "pt", order: Sequence[str] = ()
) -> None:
    """Replace one day partition below ``path``; the other days stay.

    The rows are written beside the day, in a folder that readers skip, and then take its place by
    renaming: a job that fails leaves the old day as it was, and a stop between the two renames is put right
    by the next write of that day. Also an empty result replaces what an earlier attempt left. Where
    no reader may miss the day even between two renames, use a table and :func:`overwrite_table_day`.
    """
    spark = df.sparkSession
    name = f"{day_column}={day_text(day)}"
    target, beside = f"{path}/{name}", f"{path}/_staging/{name}"
    _settle(spark, target, beside)
    try:
        _sorted(df.drop(day_column), order).write.parquet(f"{beside}/new")
        if files.exists(spark, target):
            files.rename(spark, target, f"{beside}/old")
        files.rename(spark, f"{beside}/new", target)
    finally:
        _settle(spark, target, beside)


def _settle(spark: SparkSession, target: str, beside: str) -> None:
    """Undo an attempt that moved the old day away and then stopped; clear what an attempt left."""
    if not files.exists(spark, target) and files.exists(spark, f"{beside}/old"):
        files.rename(spark, f"{beside}/old", target)
    files.delete(spark, beside)


def overwrite_table_day(
    df: DataFrame, day: date | str, table: str, day_column: str = "pt", order: Sequence[str] = ()
) -> None:
    """Replace one day partition of a declared table, matching columns by name.

    Tables of files get a new version of the day in a folder of its own, and the catalog entry of the
    partition moves to it in one step: readers see the old day or the new one, and a job that fails
    leaves the old one. The version before stays for queries that still read it, until the next
    overwrite of that day. Other formats commit by themselves.
    """
    spark = df.sparkSession
    columns = [c for c in spark.table(table).columns if c != day_column]
    rows = _sorted(df.select(*columns), order)
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    provider = (described.get("Provider") or "").lower()
    if provider not in ("parquet", "orc", "json", "csv"):
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (`{day_column}` = {{day}}) SELECT * FROM {{rows}}",
            day=day_text(day),
            rows=rows,
        )
        return
    versions = f"{described['Location']}/_days/{day_column}={day_text(day)}"
    new = uuid.uuid4().hex
    kinds = {f.name: f.dataType for f in spark.table(table).schema.fields}
    typed = rows.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in columns])
    typed.write.format(provider).save(f"{versions}/{new}")
    part = f"PARTITION (`{day_column}` = '{day_text(day)}')"
    known = spark.sql(f"SHOW PARTITIONS {table} {part}").count() > 0
    before = ""
    if known:
        details = spark.sql(f"DESCRIBE EXTENDED {table} {part}").collect()
        before = next(r.data_type for r in details if r.col_name == "Location")
        spark.sql(f"ALTER TABLE {table} {part} SET LOCATION '{versions}/{new}'")
    else:
        spark.sql(f"ALTER TABLE {table} ADD {part} LOCATION '{versions}/{new}'")
    for name in files.children(spark, versions):
        if name != new and not before.endswith(f"/{name}"):
            files.delete(spark, f"{versions}/{name}")


def write_sorted(df: DataFrame, path: str, order: Sequence[str], rows_per_file: int = 5_000_000) -> None:
    """Files that follow each other in ``order`` and are sorted inside, so that a range of keys is in few of them.

    Bounds of the files are sampled from the rows, which are written to a scratch table first so that the
    plan before runs once; a key with very many rows spans files if ``order`` has a further column.
    """
    with scratch_scope(df.sparkSession):
        rows = staged(df, "unsorted")
        count = max(1, -(-rows.count() // rows_per_file))
        parts = rows.repartitionByRange(count, *order).sortWithinPartitions(*order)
        parts.write.mode("overwrite").parquet(path)


def checked(df: DataFrame, schema: T.StructType, day_column: str = "pt") -> DataFrame:
    """``df`` in the columns and types of a sink; a column that it lacks raises."""
    fields = [f for f in schema.fields if f.name != day_column]
    absent = [f.name for f in fields if f.name not in df.columns]
    if absent:
        raise ValueError(f"columns missing for the sink: {', '.join(absent)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def write_csv(
    df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite", order: Sequence[str] = ()
) -> None:
    """CSV with a header, each file in ``order``; nested columns become JSON cells."""
    cells = [
        F.to_json(f.name).alias(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        else F.col(f.name)
        for f in df.schema.fields
    ]
    _sorted(df, order).select(cells).write.mode(mode).option("sep", sep).option("header", True).csv(path)


def write_batches(df: DataFrame, path: str, batch_column: str = "batch_id") -> None:
    """One folder per batch. The rebalance keeps files of even size, also for one big batch."""
    df.hint("rebalance", F.col(batch_column)).write.mode("overwrite").partitionBy(
        batch_column
    ).parquet(path)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches as one frame, with their ``batch_id``."""
    return spark.read.parquet(path)


def write_splits(
    samples: DataFrame,
    path: str,
    x_offsets: Sequence[int],
    y_offsets: Sequence[int],
    split_column: str = "split",
) -> None:
    """Train/val/test sets, one folder per split, with the step offsets of x and y."""
    (
        samples.withColumns(
            {
                "x_offsets": F.array(*[F.lit(int(o)) for o in x_offsets]),
                "y_offsets": F.array(*[F.lit(int(o)) for o in y_offsets]),
            }
        )
        .hint("rebalance", F.col(split_column))
        .write.mode("overwrite")
        .partitionBy(split_column)
        .parquet(path)
    )


FEATURE_TYPES = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("feature", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("coding", T.StringType()),
        T.StructField("size", T.IntegerType()),
    ]
)


def write_feature_types(spark: SparkSession, types: dict[str, tuple], path: str) -> None:
    """Feature typing config as JSON lines, in vector order."""
    rows = [(i, name, *spec) for i, (name, spec) in enumerate(types.items())]
    spark.createDataFrame(rows, FEATURE_TYPES).coalesce(1).write.mode("overwrite").json(path)


def read_feature_types(spark: SparkSession, path: str) -> dict[str, tuple]:
    rows = spark.read.schema(FEATURE_TYPES).json(path).orderBy("position").collect()
    return {r.feature: (r.kind, r.coding, r["size"]) for r in rows}


@contextmanager
def reused(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame in memory and on disk while two or more actions read it."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
