"""Descriptive profiles of rides and checks of panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.functions import keys as K
from dockflow.operators import numbering
from dockflow.sources.scratch import staged
from dockflow.operators.flow import ride_ends

# fixed values: calendar order of weekdays
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def data_range(rides: DataFrame) -> DataFrame:
    """Row count, first and last departure and the number of start stations."""
    return rides.agg(
        F.count("*").alias("rides"),
        F.min("started_at").alias("first_start"),
        F.max("started_at").alias("last_start"),
        F.count_distinct("start_station_id").alias("stations"),
    )


def approximate_stations(rides: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Approximate number of start stations, where the exact one is too slow."""
    return rides.agg(F.approx_count_distinct("start_station_id", rsd).alias("stations"))


def calendar_counts(rides: DataFrame) -> DataFrame:
    """Departures and arrivals per (weekday, hour of day): at most 168 rows."""
    return (
        ride_ends(rides)
        .groupBy(K.weekday_monday0("at").alias("weekday"), F.hour("at").alias("hour_of_day"))
        .agg(F.sum("outflow").alias("outflow"), F.sum("inflow").alias("inflow"))
        .dropna(subset=["weekday"])
    )


def _profile(counts: DataFrame, key: str) -> DataFrame:
    """Totals per value of a key; null where there are none of a kind."""
    some = lambda c: F.when(F.sum(c) > 0, F.sum(c)).alias(c)
    return counts.groupBy(key).agg(some("outflow"), some("inflow"))


def hour_profile(counts: DataFrame) -> DataFrame:
    """Departures, arrivals and their difference per hour of day (hours with departures).

    Takes ``calendar_counts``, as the weekday profile does, so both can share one scan.
    """
    return (
        _profile(counts, "hour_of_day")
        .filter(F.col("outflow").isNotNull())
        .withColumn("net_flow", F.col("inflow") - F.col("outflow"))
    )


def weekday_calendar(spark: SparkSession) -> DataFrame:
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    return spark.range(1).select(F.posexplode(names).alias("weekday", "day_name"))


def weekday_profile(counts: DataFrame) -> DataFrame:
    """The same per weekday, all seven, Monday first; null on weekdays without rides."""
    return (
        weekday_calendar(counts.sparkSession)
        .join(_profile(counts, "weekday"), "weekday", "left")
        .withColumn("net_flow", F.col("inflow") - F.col("outflow"))
    )


def station_totals(rides: DataFrame, days: int) -> DataFrame:
    """Departures and arrivals per station that has departures, and departures per day."""
    return (
        ride_ends(rides)
        .groupBy("station_id")
        .agg(F.sum("outflow").alias("total_outflow"), F.sum("inflow").alias("total_inflow"))
        .filter(F.col("station_id").isNotNull() & (F.col("total_outflow") > 0))
        .withColumn("avg_daily_outflow", F.col("total_outflow") / days)
        .withColumn("net_flow", F.col("total_inflow") - F.col("total_outflow"))
    )


def value_at_rank(values: DataFrame, column: str, rank: int, bins: int = 4096) -> float | None:
    """The value with ``rank`` (from 0) smaller ones before it, by refining a histogram; nulls and NaN are left out.

    Each pass counts the values of the range that is left in ``bins`` bins and goes on inside the bin
    with the rank, between the smallest and the largest value there, until the two are equal. A pass moves one
    row per bin, however many distinct values there are. ``values`` is read once per pass.
    """
    x = values.select(F.col(column).cast("double").alias("x")).filter("x is not null and not isnan(x)")
    low, high = x.agg(F.min("x"), F.max("x")).first()
    if low is None:
        return None
    while low < high:
        # halves, so that the width of the whole range of doubles is finite
        place = (F.col("x") / 2 - low / 2) / (high / 2 - low / 2) * bins
        inside = x.filter(F.col("x").between(low, high))
        counted = inside.groupBy(F.least(F.floor(place), F.lit(bins - 1)).alias("bin")).agg(
            F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
        )
        for r in sorted(counted.collect(), key=lambda r: r["bin"]):
            if rank < r["n"]:
                low, high = r["low"], r["high"]
                break
            rank -= r["n"]
        else:
            return None
    return low


def exact_median(values: DataFrame, column: str) -> float | None:
    """Median of a column, the mean of the two middle values where their number is even."""
    n = values.filter(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).count()
    if not n:
        return None
    low = value_at_rank(values, column, (n - 1) // 2)
    return low if n % 2 else (low + value_at_rank(values, column, n // 2)) / 2


def station_stats(
    totals: DataFrame, above: Sequence[int] = (1000, 6000), extreme: int = 200
) -> DataFrame:
    """Spread of station totals and counts of stations beyond thresholds.

    The totals are written once; the exact median comes from passes over them that never gather values.
    """
    totals = staged(totals, "totals")
    out, net = F.col("total_outflow"), F.col("net_flow")
    return totals.agg(
        F.count("*").alias("stations"),
        F.avg(out).alias("mean_outflow"),
        F.lit(exact_median(totals, "total_outflow")).cast("double").alias("median_outflow"),
        F.max(out).alias("max_outflow"),
        F.min(out).alias("min_outflow"),
        *[F.count_if(out > limit).alias(f"outflow_over_{limit}") for limit in above],
        F.avg(net).alias("mean_netflow"),
        F.max(net).alias("max_netflow"),
        F.min(net).alias("min_netflow"),
        F.count_if(net > 0).alias("attracting"),
        F.count_if(net < 0).alias("sending"),
        F.count_if(net > extreme).alias("extreme_in"),
        F.count_if(net < -extreme).alias("extreme_out"),
    )


def histogram(
    df: DataFrame,
    column: str,
    bins: int,
    low: float | None = None,
    high: float | None = None,
    at_most: float | None = None,
    at_least: float | None = None,
) -> DataFrame:
    """Equal-width histogram: (bin, bin_start, bin_end, count), bins with values only.

    The range is ``low``..``high``; where ``at_most`` or ``at_least`` is given instead, the
    lower or upper end is that value or the smallest or largest value, whichever is further
    out. A value on the upper end belongs to the last bin. The column is written once, its range is one row read
    from there, and bins are counted before anything is shuffled, so it may hold any number of distinct values.
    """
    lower = F.lit(low) if low is not None else F.least(F.min("_x"), F.lit(at_most))
    upper = F.lit(high) if high is not None else F.greatest(F.max("_x"), F.lit(at_least))
    values = staged(df.select(F.col(column).cast("double").alias("_x")).dropna(), "values")
    lo, hi = values.agg(lower.cast("double"), upper.cast("double")).first()
    lo, hi = F.lit(lo).cast("double"), F.lit(hi).cast("double")
    number = F.least(F.width_bucket("_x", lo, hi, F.lit(bins)), F.lit(bins))
    counted = values.groupBy((number - 1).alias("bin")).agg(F.count("*").alias("count"))
    edge = lambda i: lo + (hi - lo) / bins * i
    return counted.select(
        "bin", edge(F.col("bin")).alias("bin_start"), edge(F.col("bin") + 1).alias("bin_end"), "count"
    )


def outflow_histogram(totals: DataFrame, bins: int = 50, at_least: float = 6000) -> DataFrame:
    return histogram(totals, "total_outflow", bins, low=0, at_least=at_least)


def netflow_histogram(totals: DataFrame, bins: int = 60, reach: float = 200) -> DataFrame:
    return histogram(totals, "net_flow", bins, at_most=-reach, at_least=reach)


def top_stations(totals: DataFrame, count: int = 10) -> DataFrame:
    """Stations with most departures; ties in station order."""
    return totals.orderBy(F.desc("total_outflow"), F.asc("station_id")).limit(count)


def by_outflow(totals: DataFrame) -> DataFrame:
    return totals.orderBy(F.desc("total_outflow"), F.asc("station_id"))


def ranking(totals: DataFrame) -> DataFrame:
    """``rank`` of every station in that order, from 1."""
    keyed = totals.withColumn("_least", -F.col("total_outflow"))
    return numbering.row_numbers(keyed, ["_least", "station_id"], "rank").drop("_least")


def extremes(profile: DataFrame, key: str, order: str, value: str = "outflow") -> DataFrame:
    """Key with the largest and with the smallest value; ties go to the first in order."""
    known = profile.filter(F.col(value).isNotNull())
    first_largest = F.max_by(key, F.struct(F.col(value), -F.col(order)))
    first_smallest = F.min_by(key, F.struct(F.col(value), F.col(order)))
    return known.agg(
        first_largest.cast("string").alias("busiest"),
        F.max(value).alias("largest"),
        first_smallest.cast("string").alias("quietest"),
        F.min(value).alias("smallest"),
    )


def peak_hours(rides: DataFrame) -> DataFrame:
    """Busiest and quietest hour of day and weekday by departures."""
    counts = calendar_counts(rides)
    hours = extremes(hour_profile(counts), "hour_of_day", "hour_of_day")
    days = extremes(weekday_profile(counts), "day_name", "weekday")
    kind = lambda df, name: df.select(F.lit(name).alias("kind"), "*")
    return kind(hours, "hour").unionByName(kind(days, "weekday"))


def daily_volume(rides: DataFrame) -> DataFrame:
    """Rides per day of arrival; rides without an arrival are left out."""
    return (
        rides.groupBy(F.col("ended_at").cast("date").alias("day"))
        .agg(F.count("*").alias("order_count"))
        .dropna(subset=["day"])
    )


def volume_stats(volume: DataFrame) -> DataFrame:
    return volume.agg(
        F.avg("order_count").alias("mean_orders"),
        F.max("order_count").alias("max_orders"),
        F.min("order_count").alias("min_orders"),
        F.count("*").alias("days"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in df.columns])


def value_counts(df: DataFrame) -> DataFrame:
    """Non-null values per column, one row."""
    return df.agg(*[F.count(c).alias(f"{c}_values") for c in df.columns])


def completeness(panel: DataFrame, key: str = "station_id", columns: Sequence[str] = ()) -> DataFrame:
    """Are all keys equally long? Keys, fewest and most rows, distinct lengths, nulls."""
    per_key = panel.groupBy(key).agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return per_key.agg(
        F.count("*").alias("keys"),
        F.min("_rows").alias("min_rows"),
        F.max("_rows").alias("max_rows"),
        F.count_distinct("_rows").alias("distinct_lengths"),
        F.sum("_rows").alias("rows"),
        *[F.sum(c).alias(f"{c}_nulls") for c in columns],
    )


def shape(df: DataFrame) -> tuple[int, int]:
    """Rows and columns."""
    return df.count(), len(df.columns)


def shape_row(df: DataFrame) -> DataFrame:
    """Rows and columns as one row."""
    return df.agg(F.count("*").alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns"))


def preview(df: DataFrame, order: Sequence[str], rows: int = 20) -> DataFrame:
    """The first rows in a total order, nulls last."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in order]).limit(rows)
