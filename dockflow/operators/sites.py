"""Daily orders per site, site activity and eligibility."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.operators.flow import time_range


def daily_orders(
    orders: DataFrame,
    site: str = "site_guid",
    day: str = "pt",
    order: str = "order_id",
    capacity: str | None = "capacity",
) -> DataFrame:
    """Orders (with an id) and largest capacity per (site, day); days without orders are absent."""
    aggregates = [F.count(order).alias("daily_order_cnt")]
    if capacity is not None:
        aggregates.append(F.max(capacity).alias("parking_capacity"))
    return orders.groupBy(site, day).agg(*aggregates)


def site_activity(daily: DataFrame, site: str = "site_guid") -> DataFrame:
    """Largest and mean daily count per site; the mean is over days with orders."""
    return daily.groupBy(site).agg(
        F.max("daily_order_cnt").alias("max_daily_orders"),
        F.avg("daily_order_cnt").alias("mean_daily_orders"),
    )


def eligible_sites(
    activity: DataFrame, max_at_least: float | None = None, mean_at_least: float | None = None
) -> DataFrame:
    """Sites that reach either threshold (a threshold of None is not used).

    Both come from one aggregate, which is the distinct union of the two site sets.
    """
    by_max = F.lit(False) if max_at_least is None else F.col("max_daily_orders") >= max_at_least
    by_mean = F.lit(False) if mean_at_least is None else F.col("mean_daily_orders") >= mean_at_least
    return activity.filter(by_max | by_mean)


def either_set(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct union of two given site sets."""
    return a.union(b).distinct()


def keep_sites(df: DataFrame, sites: DataFrame, column: str, site: str = "site_guid") -> DataFrame:
    """Rows whose site is in the set; rows without a site fall out."""
    return df.join(sites.select(F.col(site).alias(column)), column, "left_semi")


def busy_stations(
    rides: DataFrame, start: str, before: str, mean_at_least: float
) -> DataFrame:
    """Stations by mean daily departures in ``start <= started_at < before``."""
    daily = (
        time_range(rides, "started_at", start, before)
        .dropna(subset=["start_station_id"])
        .groupBy("start_station_id", F.col("started_at").cast("date").alias("day"))
        .agg(F.count("*").alias("daily_order_cnt"))
    )
    return (
        daily.groupBy(F.col("start_station_id").alias("station_id"))
        .agg(F.avg("daily_order_cnt").alias("avg_daily_orders"))
        .filter(F.col("avg_daily_orders") >= mean_at_least)
    )
