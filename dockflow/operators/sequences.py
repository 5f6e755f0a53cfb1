"""Sequences of feature vectors per site: packing, JSON, decoding and validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.functions.vectors import vector


def latest_rows(df: DataFrame, key: str, time: str, count: int) -> DataFrame:
    """The ``count`` latest rows of every key.

    Spark limits each key to ``count`` rows already before the shuffle, so a key with very
    many rows does not reach one task whole. It does so up to a threshold of the session, which
    is raised here where ``count`` is beyond it.
    """
    spark, limit = df.sparkSession, "spark.sql.optimizer.windowGroupLimitThreshold"
    if int(spark.conf.get(limit)) < count:
        spark.conf.set(limit, str(count))
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.desc(time)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= count).drop("_rank")


def in_order(key: str, value: Column) -> Column:
    """Values of a group gathered in the order of ``key``, whatever the shuffle did."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), value.alias("v"))))
    return F.transform(pairs, lambda p: p["v"])


def pack_sequences(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    features: Sequence[str],
    steps: int | None = None,
    name: str = "features",
) -> DataFrame:
    """One row per key with the ordered array of its feature vectors.

    With ``steps`` the latest ``steps`` rows are taken and shorter keys fall out. The first
    key alone defines the sequence; the others must depend on it (as a city on its site).
    """
    if steps is not None:
        df = latest_rows(df, keys[0], time, steps)
    packed = df.groupBy(*keys).agg(
        in_order(time, vector(features)).alias(name), F.count("*").alias("_steps")
    )
    if steps is not None:
        packed = packed.filter(F.col("_steps") == steps)
    return packed.drop("_steps")


def join_sequences(hourly: DataFrame, daily: DataFrame, key: str = "site_guid") -> DataFrame:
    """Hourly sequences with the daily sequence of the same site, null where it has none."""
    return hourly.join(daily, key, "left")


def decode_sequences(
    encoded: DataFrame, column: str, steps: int, width: int, name: str = "steps"
) -> DataFrame:
    """Parse JSON matrices and state what is wrong with each (``reject_reason``, null if good).

    Reasons: ``bad_json`` (not a list of lists), ``bad_length``, ``bad_width``, ``bad_value``
    (an element that is null or not a number; numbers written as text are numbers).
    """
    number = lambda v: F.translate(v, '"', "").try_cast("double")
    numbers = F.transform("_text", lambda s: F.transform(s, number))
    reason = (
        F.when(F.col(name).isNull(), "bad_json")
        .when(F.size(name) != steps, "bad_length")
        .when(F.exists(name, lambda s: s.isNull() | (F.size(s) != width)), "bad_width")
        .when(F.exists(name, lambda s: F.exists(s, lambda v: v.isNull())), "bad_value")
    )
    kept = [c for c in encoded.columns if c != name]
    only = lambda c: F.explode(F.array(c))
    # one-element explodes keep the parsed values: a filter on the reason must not parse again.
    # Numbers are read as such; only what fails that way is read as text.
    return (
        encoded.select(*kept, only(F.from_json(column, "array<array<double>>")).alias("_plain"))
        .select(
            "*",
            only(
                F.when(F.col("_plain").isNull(), F.from_json(column, "array<array<string>>"))
            ).alias("_text"),
        )
        .select("*", only(F.coalesce("_plain", numbers)).alias(name))
        .select(*kept, name, only(reason).alias("reject_reason"))
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(decoded: DataFrame, name: str = "steps") -> DataFrame:
    """Quarantine: the original rows and the reason."""
    return decoded.filter(F.col("reject_reason").isNotNull()).drop(name)


def as_float32(decoded: DataFrame, name: str = "steps") -> DataFrame:
    """Values in single precision, the type models read."""
    return decoded.withColumn(name, F.col(name).cast("array<array<float>>"))


def alignment(
    a: DataFrame, b: DataFrame, key: str, by: Sequence[str] = (), names=("left", "right")
) -> DataFrame:
    """How many keys are in both frames and in one only, per ``by`` columns of either."""
    mark = lambda df, name: df.select(key, *by, F.lit(True).alias(name))
    both = mark(a, "_a").join(mark(b, "_b"), [key, *by], "full")
    has_a, has_b = F.col("_a").isNotNull(), F.col("_b").isNotNull()
    return both.groupBy(*by).agg(
        F.count_if(has_a & has_b).alias("both"),
        F.count_if(has_a & ~has_b).alias(f"{names[0]}_only"),
        F.count_if(~has_a & has_b).alias(f"{names[1]}_only"),
    )
