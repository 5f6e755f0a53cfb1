"""Forecast errors over a long table (target, day_idx, hour, y_true, y_pred).

Every metric is one aggregate with partial sums before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: hour ranges (first, last) of the slices
PEAK_SLICES = {"morning": (7, 9), "evening": (18, 20), "all_day": (0, 23)}
DAILY_SLICES = {"day": (0, 23), "morning": (8, 8), "afternoon": (13, 13), "evening": (19, 19)}


def _error() -> Column:
    return F.col("y_pred") - F.col("y_true")


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def _masked(mask: Column, error: Column) -> dict[str, Column]:
    truth = F.col("y_true")
    keep = lambda c: F.when(mask, c)
    return {
        "mse": F.avg(keep(error * error)),
        "mape": F.avg(keep(F.abs(_ratio(error, truth)))),
        "wmape": _ratio(F.sum(keep(F.abs(error))), F.sum(keep(F.abs(truth)))),
        "rows": F.count_if(mask),
    }


def _by_slice(
    df: DataFrame,
    by: Sequence[str],
    slices: Mapping[str, tuple[int, int]],
    wanted: Sequence[str],
    mask: Column,
    error: Column,
) -> DataFrame:
    """All slices from one pass: one set of aggregate columns each, then one row each."""
    columns, rows = [], []
    for name, (first, last) in slices.items():
        measures = _masked(mask & F.col("hour").between(first, last), error)
        columns += [measures[m].alias(f"_{name}_{m}") for m in wanted]
        fields = [F.col(f"_{name}_{m}").alias(m) for m in wanted]
        rows.append(F.struct(F.lit(name).alias("slice"), *fields))
    return df.groupBy(*by).agg(*columns).select(*by, F.inline(F.array(*rows)))


def slice_metrics(
    df: DataFrame,
    by: Sequence[str] = (),
    slices: Mapping[str, tuple[int, int]] = PEAK_SLICES,
    above: float = 5,
    inclusive: bool = False,
) -> DataFrame:
    """MSE, MAPE and WMAPE pooled over rows with a truth above the threshold, by hour slice.

    A slice with no such row has null metrics and ``rows`` 0.
    """
    mask = F.col("y_true") >= above if inclusive else F.col("y_true") > above
    return _by_slice(df, by, slices, ("mse", "mape", "wmape", "rows"), mask, _error())


def daily_metrics(
    df: DataFrame,
    by: Sequence[str] = ("target", "day_idx"),
    slices: Mapping[str, tuple[int, int]] = DAILY_SLICES,
    at_least: float = 5,
) -> DataFrame:
    """MAPE and WAPE per day and slice, of forecasts rounded half to even."""
    error = F.bround("y_pred", 0) - F.col("y_true")
    mask = F.col("y_true") >= at_least
    return _by_slice(df, by, slices, ("mape", "wmape", "rows"), mask, error).withColumnRenamed(
        "wmape", "wape"
    )


def mean_of_days(daily: DataFrame, by: Sequence[str] = ("target", "slice")) -> DataFrame:
    """Unweighted means of the daily values; days without a value are counted apart."""
    return daily.groupBy(*by).agg(
        F.avg("mape").alias("mape"),
        F.avg("wape").alias("wape"),
        F.count_if(F.col("mape").isNull()).alias("empty_days"),
    )


def peak_huber(
    df: DataFrame, by: Sequence[str] = (), peak: float = 5, delta: float = 5, peak_weight: float = 2
) -> DataFrame:
    """Huber mean of peak truths (weighted) plus absolute mean of the others; empty class adds 0."""
    size = F.abs(_error())
    is_peak = F.col("y_true") >= peak
    huber = F.when(size <= delta, 0.5 * size * size).otherwise(delta * (size - 0.5 * delta))
    zero = F.lit(0.0)
    at_peak = F.coalesce(F.avg(F.when(is_peak, huber)), zero)
    elsewhere = F.coalesce(F.avg(F.when(~is_peak, size)), zero)
    return df.groupBy(*by).agg(
        (at_peak * peak_weight + elsewhere).alias("loss"), F.count("*").alias("rows")
    )


def multi_target_loss(
    df: DataFrame, weights: Mapping[int, float] | None = None, target: str = "target", **kwargs
) -> DataFrame:
    """Peak-weighted loss per target with its weight, and the weighted sum of all targets."""
    weight = F.lit(1.0)
    for value, w in (weights or {}).items():
        weight = F.when(F.col(target) == value, F.lit(float(w))).otherwise(weight)
    per_target = peak_huber(df, [target], **kwargs).select(
        target, "loss", (weight * F.col("loss")).alias("weighted_loss")
    )
    total = per_target.agg(F.sum("weighted_loss")).scalar()
    return per_target.withColumn("total_loss", total)


def smooth_l1(beta: float = 5) -> Column:
    """Row-wise smooth absolute error."""
    size = F.abs(_error())
    return F.when(size < beta, 0.5 * size * size / beta).otherwise(size - 0.5 * beta)


def overall_error(df: DataFrame, by: Sequence[str] = (), beta: float = 5) -> DataFrame:
    """MAE, RMSE, MSE and smooth absolute error over all rows."""
    return df.groupBy(*by).agg(
        F.avg(F.abs(_error())).alias("mae"),
        F.sqrt(F.avg(_error() * _error())).alias("rmse"),
        F.avg(_error() * _error()).alias("mse"),
        F.avg(smooth_l1(beta)).alias("smooth_l1"),
        F.count("*").alias("rows"),
    )


def averaged_loss(df: DataFrame, batch: str, by: Sequence[str] = (), **kwargs) -> DataFrame:
    """Loss per batch, averaged by batch size and as a plain mean over batches."""
    return (
        peak_huber(df, [*by, batch], **kwargs)
        .groupBy(*by)
        .agg(
            (F.sum(F.col("loss") * F.col("rows")) / F.sum("rows")).alias("weighted_mean_loss"),
            F.avg("loss").alias("batch_mean_loss"),
            F.count("*").alias("batches"),
        )
    )


def horizon_metrics(
    df: DataFrame, horizon: str = "hour", by: Sequence[str] = (), mask_zero: bool = True
) -> DataFrame:
    """MAE, MAPE and RMSE per step ahead.

    With ``mask_zero`` rows with a zero truth do not enter any of them, otherwise they enter
    MAE and RMSE only (a relative error does not exist there).
    """
    if mask_zero:
        df = df.filter(F.col("y_true") != 0)
    return df.groupBy(*by, horizon).agg(
        F.avg(F.abs(_error())).alias("mae"),
        F.avg(F.abs(_ratio(_error(), F.col("y_true")))).alias("mape"),
        F.sqrt(F.avg(_error() * _error())).alias("rmse"),
    )


def mean_over_horizons(per_horizon: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return per_horizon.groupBy(*by).agg(*[F.avg(m).alias(m) for m in ("mae", "mape", "rmse")])
