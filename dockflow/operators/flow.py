"""Hourly flow per station, the dense station-by-hour panel and forward sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.functions.keys import floor_hour, hour_spine


def _station(name: str, keep_unknown: bool) -> Column:
    """Station id as text; a missing one is dropped later or becomes station ``nan``."""
    station = F.col(name).cast("string")
    return F.coalesce(station, F.lit("nan")) if keep_unknown else station


def hourly_counts(
    rides: DataFrame, station: str, time: str, name: str, keep_unknown: bool = False
) -> DataFrame:
    """Rides per (station, hour) at one end of the ride."""
    return (
        rides.groupBy(
            _station(station, keep_unknown).alias("station_id"), floor_hour(time).alias("hour")
        )
        .agg(F.count("*").alias(name))
        .dropna(subset=["station_id", "hour"])
    )


def hourly_outflow(rides: DataFrame, keep_unknown: bool = False) -> DataFrame:
    return hourly_counts(rides, "start_station_id", "started_at", "outflow", keep_unknown)


def hourly_inflow(rides: DataFrame, keep_unknown: bool = False) -> DataFrame:
    return hourly_counts(rides, "end_station_id", "ended_at", "inflow", keep_unknown)


def merge_flows(inflow: DataFrame, outflow: DataFrame) -> DataFrame:
    """Full outer merge of two given hourly counts, zero for the missing side."""
    return inflow.join(outflow, ["station_id", "hour"], "full").fillna(0)


def ride_ends(rides: DataFrame, keep_unknown: bool = False) -> DataFrame:
    """Two rows per ride, its departure and its arrival: (station_id, at, inflow, outflow)."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    departure = F.struct(
        _station("start_station_id", keep_unknown).alias("station_id"),
        F.col("started_at").alias("at"),
        zero.alias("inflow"),
        one.alias("outflow"),
    )
    arrival = F.struct(
        _station("end_station_id", keep_unknown).alias("station_id"),
        F.col("ended_at").alias("at"),
        one.alias("inflow"),
        zero.alias("outflow"),
    )
    return rides.select(F.inline(F.array(departure, arrival)))


def hourly_flow(rides: DataFrame, keep_unknown: bool = False) -> DataFrame:
    """Inflow and outflow per (station, hour) in one scan and one shuffle.

    Equal to the outer merge of the two counts. Counts are summed before the shuffle, so a
    busy station costs no more than a quiet one.
    """
    return (
        ride_ends(rides, keep_unknown)
        .groupBy("station_id", floor_hour("at").alias("hour"))
        .agg(F.sum("inflow").alias("inflow"), F.sum("outflow").alias("outflow"))
        .dropna(subset=["station_id", "hour"])
    )


def dense_panel(hourly: DataFrame, start: str, end: str) -> DataFrame:
    """Every station of ``hourly`` at every hour of ``start``..``end``, zero where it has none.

    The observed hours of a station are gathered (at most one entry per hour of the range),
    zero rows of the spine are put next to them and both are summed by (station, hour). Only
    observed rows are shuffled, once, by station; the spine is generated behind the shuffle and
    later windows by station need no further one.
    """
    spine = hour_spine(start, end)
    in_range = F.col("hour").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    flows = ["inflow", "outflow"]
    observed = F.collect_list(F.when(in_range, F.struct("hour", *flows)))
    zero = [F.lit(0).cast("bigint").alias(c) for c in flows]
    blank = F.transform(spine, lambda h: F.struct(h.alias("hour"), *zero))
    return (
        hourly.groupBy("station_id")
        .agg(observed.alias("seen"))
        .select("station_id", F.inline(F.concat("seen", blank)))
        .groupBy("station_id", "hour")
        .agg(*[F.sum(c).alias(c) for c in flows])
    )


def forward_sums(
    panel: DataFrame,
    columns: dict[str, str | Column],
    hours: int = 12,
    complete: bool = True,
    station: str = "station_id",
    time: str = "hour",
) -> DataFrame:
    """Sum over the current and the next ``hours - 1`` rows of a station.

    ``columns`` maps result names to input columns. With ``complete`` the sum is null where
    fewer than ``hours`` rows remain. A station has at most one row per hour of the panel.
    """
    ahead = W.partitionBy(station).orderBy(time).rowsBetween(0, hours - 1)
    sums = {}
    for name, source in columns.items():
        total = F.sum(source).over(ahead)
        sums[name] = F.when(F.count(F.lit(1)).over(ahead) == hours, total) if complete else total
    return panel.withColumns(sums)


def future_flow(panel: DataFrame, hours: int = 12, cutoff: str | None = None) -> DataFrame:
    """Forward in-, out- and net flow (positive net = arrivals prevail), up to ``cutoff``."""
    names = {f"future_{hours}h_{c}": c for c in ("inflow", "outflow")}
    inflow, outflow = names
    out = (
        forward_sums(panel, names, hours)
        .withColumn(f"future_{hours}h_netflow", F.col(inflow) - F.col(outflow))
        .select(
            "station_id",
            F.col("hour").cast("date").alias("date"),
            "hour",
            F.hour("hour").alias("hour_of_day"),
            inflow,
            outflow,
            f"future_{hours}h_netflow",
        )
    )
    if cutoff is not None:
        out = out.filter(F.col("hour") <= F.lit(cutoff).cast("timestamp_ntz"))
    return out


def time_range(df: DataFrame, time: str, start: str | None = None, before: str | None = None) -> DataFrame:
    """Half-open time filter: ``start <= time < before``."""
    if start is not None:
        df = df.filter(F.col(time) >= F.lit(start).cast("timestamp_ntz"))
    if before is not None:
        df = df.filter(F.col(time) < F.lit(before).cast("timestamp_ntz"))
    return df
