"""Exact global row numbers, pages and exact-size samples without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.sources.scratch import staged

#: Rows that one task sorts; the number of ranges follows from it and the number of rows.
ROWS_PER_RANGE = 1_000_000


def ranged(df: DataFrame, order: Sequence[str | Column], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``df`` written in ranges of ``order``, with ``_range`` and the place ``_place`` (from 0) in its range.

    The caller's plan runs once, into a scratch table; bounds are sampled from that table, and there are as
    many ranges as its rows need. Ranges are written too, so a task that runs again finds the same ones.
    """
    rows = staged(df, "rows")
    ranges = max(1, -(-rows.count() // rows_per_range))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    parts = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return staged(parts.withColumns({"_range": F.spark_partition_id(), "_place": place}), "ranges")


def running_totals(
    df: DataFrame, order: Sequence[str], value: str, name: str, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Sum of ``value`` over all rows before each row, by unique keys ``order``.

    A row's total is that of the ranges before its own, from a table of one row per range, plus that of the
    rows before it in its range, so no task sorts more than one range.
    """
    parts = ranged(df, order, rows_per_range)
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    ahead = W.partitionBy("_range").orderBy("_place").rowsBetween(W.unboundedPreceding, -1)
    per_range = parts.groupBy("_range").agg(F.sum(value).alias("_sum"))
    offsets = per_range.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = parts.withColumn("_ahead", F.coalesce(F.sum(value).over(ahead), F.lit(0)))
    return inside.join(offsets, "_range").select(
        *df.columns, (F.col("_offset") + F.col("_ahead")).alias(name)
    )


def row_numbers(
    keys: DataFrame,
    order: Sequence[str | Column],
    name: str = "row_id",
    by: Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Number the rows 1..n in ``order``, within every group of the columns ``by`` (never null) if given.

    A group may hold any share of the rows: ranges cut through groups, and a table of one row per range and
    group in it says how many rows of the group lie before. Rows that ``order`` does not tell apart
    get their numbers in any order.
    """
    parts = ranged(keys, [*by, *order], rows_per_range)
    per_range = parts.groupBy("_range", *by).agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    before = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_range.select(
        "_range", *by, (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_offset")
    )
    return parts.join(offsets, ["_range", *by]).select(
        *keys.columns, (F.col("_offset") + F.col("_place")).alias(name)
    )


def number_rows(df: DataFrame, key: str, name: str = "row_id") -> DataFrame:
    """Row numbers by a unique key for wide rows: only the key is sorted, then joined back."""
    return df.join(row_numbers(df.select(key), [key], name), key)


def pages(numbered: DataFrame, size: int, row: str = "row_id", name: str = "batch_id") -> DataFrame:
    """Page number (from 0) of every numbered row."""
    return numbered.withColumn(name, F.floor((F.col(row) - 1) / size))


def page(numbered: DataFrame, index: int, size: int, row: str = "row_id") -> DataFrame:
    """One page: row numbers ``index * size + 1`` to ``(index + 1) * size``."""
    return numbered.filter(F.col(row).between(index * size + 1, (index + 1) * size))


def hash_pages(df: DataFrame, key: str, count: int, name: str = "batch_id") -> DataFrame:
    """Pages of about equal size by key hash; no sort and no shuffle."""
    return df.withColumn(name, F.pmod(F.xxhash64(key), F.lit(count)))


def full_pages_only(
    numbered: DataFrame, size: int, row: str = "row_id", total: Column | None = None
) -> DataFrame:
    """Drop the rows of a last page that is not full; ``total`` saves the count where it is known."""
    if total is None:
        total = numbered.agg(F.count("*").alias("n")).scalar()
    return numbered.filter(F.col(row) <= F.floor(total / size) * size)


def fraction_exact(
    df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 0, buckets_hex: int = 4
) -> DataFrame:
    """A random ``int(fraction * n)`` of the rows, always the same ones for a seed.

    Rows are ordered by a hash of their (unique) keys. A histogram over the first
    ``buckets_hex`` hash digits tells which buckets are taken whole; only the rows of the one
    bucket on the border are ranked.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    hashed = df.withColumn("_hash", F.md5(text)).withColumn(
        "_bucket", F.substring("_hash", 1, buckets_hex)
    )
    upto = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)
    everything = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = F.col("_upto") - F.col("_rows")
    # at most 16 ** buckets_hex rows, here and in the broadcast
    marks = (
        hashed.groupBy("_bucket")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_upto", F.sum("_rows").over(upto))
        .withColumn("_wanted", F.floor(F.sum("_rows").over(everything) * F.lit(float(fraction))))
        .select("_bucket", "_rows", F.least("_rows", F.col("_wanted") - before).alias("_take"))
        .filter(F.col("_take") > 0)
    )
    # rows of buckets that are taken whole are windows of their own, so they are not ranked
    border = F.col("_take") < F.col("_rows")
    apart = W.partitionBy("_bucket", F.when(~border, F.col("_hash"))).orderBy("_hash", *keys)
    return (
        hashed.join(F.broadcast(marks), "_bucket")
        .withColumn("_rank", F.row_number().over(apart))
        .filter(~border | (F.col("_rank") <= F.col("_take")))
        .select(df.columns)
    )
