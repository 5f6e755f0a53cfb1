"""Forms in which forecasts are published: one row per hour, or JSON per site."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.functions import vectors as V
from dockflow.functions.keys import day_text, two_digits

# fixed values: forecast columns and the names they are published under
TARGETS = ("pred_10", "pred_16", "pred_21")
JSON_NAMES = {
    "pred_10": "period_10_netout",
    "pred_16": "period_16_netout",
    "pred_21": "period_21_netout",
}


def whole_counts(
    forecasts: DataFrame, targets: Sequence[str] = TARGETS, horizon: int = 24
) -> DataFrame:
    """Arrays of exactly ``horizon`` whole, non-negative numbers."""
    return forecasts.withColumns(
        {t: V.ceil_at_zero(V.fit_length(t, horizon)) for t in targets}
    )


def current_fences(fences: DataFrame, day: date | str, status: int = 5) -> DataFrame:
    """City of every fence in service on a day."""
    return fences.filter((F.col("pt") == day_text(day)) & (F.col("area_status") == status)).select(
        "fence_id", "city_guid"
    )


def city_fences(
    fences: DataFrame, first: date | str, last: date | str, status: int = 5, kind: int = 207
) -> DataFrame:
    """Cities with a fence of a kind in service in a day range."""
    return (
        fences.filter(
            F.col("pt").between(day_text(first), day_text(last))
            & (F.col("area_status") == status)
            & (F.col("area_type") == kind)
        )
        .select("city_guid")
        .distinct()
    )


def hourly_rows(
    counts: DataFrame,
    fences: DataFrame,
    key: str = "id",
    targets: Sequence[str] = TARGETS,
) -> DataFrame:
    """(parking_guid, city_guid, one column per target, hour) with the city where known.

    All targets unfold together, so they need no join with each other.
    """
    unfolded = counts.select(
        F.col(key).alias("parking_guid"),
        F.posexplode(F.arrays_zip(*targets)).alias("_hour", "_v"),
    )
    return unfolded.join(
        fences, F.col("parking_guid") == F.col("fence_id"), "left"
    ).select(
        "parking_guid",
        "city_guid",
        *[F.ceil(F.col("_v")[t]).alias(t) for t in targets],
        two_digits("_hour").alias("hour"),
    )


def json_rows(
    counts: DataFrame, key: str = "id", names: Mapping[str, str] = JSON_NAMES
) -> DataFrame:
    """One JSON object per site and target, ``<name>_json``; absent targets are left out."""
    present = {t: n for t, n in names.items() if t in counts.columns}
    return counts.select(
        F.col(key).alias("id"), *[V.named_json(n, t).alias(f"{n}_json") for t, n in present.items()]
    )
