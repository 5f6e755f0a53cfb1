"""Trend and seasonal parts, linear baselines and batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.functions import vectors as V
from dockflow.sources.scratch import staged

Scorer = Callable[[np.ndarray], np.ndarray]


def trend_seasonal(
    df: DataFrame, keys: Sequence[str], order: str, column: str, kernel: int = 49
) -> DataFrame:
    """Centred moving mean (``trend``) and the rest (``seasonal``) per series.

    Rows missing at either end count as the first or last value. Pass the sample index among
    the keys to treat every training window as its own series.
    """
    half = kernel // 2
    by_order = W.partitionBy(*keys).orderBy(order)
    whole = by_order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    place = F.row_number().over(by_order)
    rows = F.count(F.lit(1)).over(whole)
    before = F.greatest(F.lit(0), half + 1 - place) * F.first(column).over(whole)
    after = F.greatest(F.lit(0), half - (rows - place)) * F.last(column).over(whole)
    near = F.sum(column).over(by_order.rowsBetween(-half, half))
    return df.withColumn("trend", (near + before + after) / kernel).withColumn(
        "seasonal", F.col(column) - F.col("trend")
    )


def lag_regression(
    panel: DataFrame, site: str, time: str, column: str, lag: int = 24
) -> DataFrame:
    """Slope and intercept per site of a value on its own value ``lag`` rows before."""
    earlier = F.lag(column, lag).over(W.partitionBy(site).orderBy(time))
    return (
        panel.select(site, F.col(column).cast("double").alias("y"), earlier.cast("double").alias("x"))
        .groupBy(site)
        .agg(
            F.regr_slope("y", "x").alias("slope"),
            F.regr_intercept("y", "x").alias("intercept"),
            F.regr_count("y", "x").alias("rows"),
        )
    )


def gram_cells(samples: DataFrame, x: str, y: str) -> DataFrame:
    """Cells ``(i, j, value)`` of the inputs' and a constant's products with themselves and with ``y``.

    With p inputs the rows are i = 0..p (p is the constant 1) and the columns j = 0..p+h (behind the
    constant come the h outputs). Every task sums its rows in one matrix, and Spark sums the matrices cell by
    cell, so what is shuffled has the size of the matrix, not of the samples.
    """

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                inputs = np.stack(batch["x"].to_numpy()).astype(np.float64)
                inputs = np.c_[inputs, np.ones(len(batch))]
                both = np.c_[inputs, np.stack(batch["y"].to_numpy()).astype(np.float64)]
                part = inputs.T @ both
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"columns": [total.shape[1]], "cells": [total.ravel()]})

    rows = samples.select(F.col(x).cast("array<double>").alias("x"), F.col(y).cast("array<double>").alias("y"))
    cells = rows.mapInPandas(products, "columns int, cells array<double>").select(
        "columns", F.posexplode("cells").alias("at", "value")
    )
    place = [F.floor(F.col("at") / F.col("columns")).alias("i"), (F.col("at") % F.col("columns")).alias("j")]
    return cells.groupBy(*place).agg(F.sum("value").alias("value"))


def fit_linear(
    samples: DataFrame, x: str, y: str, horizon: int, ridge: float = 0.0
) -> tuple[np.ndarray, np.ndarray]:
    """One affine map per step ahead, from the input array to ``y[h]``, by least squares.

    Trend and seasonal parts are linear in the input, so one map stands for both. One job sums the products;
    the driver solves a system whose size does not depend on the number of samples. Returns the
    weights (inputs x horizon) and the offsets (horizon). ``ridge`` times the number of samples is added to
    the diagonal of the inputs, not of the constant.
    """
    cells = gram_cells(samples, x, y).toPandas()
    if cells.empty:
        raise ValueError("no samples to fit")
    size = int(cells["i"].max()) + 1
    full = np.zeros((size, size + horizon))
    full[cells["i"], cells["j"]] = cells["value"]
    gram, right = full[:, :size], full[:, size:]
    penalty = np.r_[np.full(size - 1, ridge * gram[-1, -1]), 0.0]
    # least norm where inputs depend on each other
    solved = np.linalg.lstsq(gram + np.diag(penalty), right, rcond=None)[0]
    return solved[:-1], solved[-1]


#: Parts of the decomposed forecaster's map, in the order of its blocks.
BLOCKS = ("seasonal", "trend")


def moving_mean(steps: int, kernel: int = 49) -> np.ndarray:
    """Matrix that takes a series of ``steps`` values to its centred moving mean; ends are repeated beyond either end."""
    half, out = kernel // 2, np.zeros((steps, steps))
    for row in range(steps):
        near = np.clip(np.arange(row - half, row - half + kernel), 0, steps - 1)
        np.add.at(out[row], near, 1 / kernel)
    return out


def _peak_weights(error: np.ndarray, peak: np.ndarray, shares: tuple[float, float], delta: float, least: float) -> np.ndarray:
    """Weights whose squares' gradient is that of the peak-weighted loss at the given errors."""
    size = np.abs(error)
    at_peak = np.minimum(1.0, delta / np.maximum(size, delta))
    return np.where(peak, shares[0] * at_peak, shares[1] / np.maximum(size, least))


def weighted_grams(
    samples: DataFrame, weigh: Callable[[np.ndarray, np.ndarray], np.ndarray], horizon: int, rows: int = 256
) -> dict[int, np.ndarray]:
    """Per step ahead h the sum over the samples of ``w_h (x, 1)' (x, 1, y_h)``.

    ``weigh(x, y)`` gives the weights of a block of samples, one per step ahead. One pass: every task sums
    its samples into one matrix per step ahead, these meet by step ahead and are added as they arrive. What
    is shuffled and returned depends on the input's length, not on the number of samples.
    """

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for at in range(0, len(batch), rows):
                part = batch.iloc[at : at + rows]
                x = np.stack(part["x"].to_numpy()).astype(np.float64)
                y = np.stack(part["y"].to_numpy()).astype(np.float64)
                w, ones = weigh(x, y), np.c_[x, np.ones(len(x))]
                both = np.stack([ones.T @ (w[:, h, None] * np.c_[ones, y[:, h]]) for h in range(horizon)])
                total = both if total is None else total + both
        if total is not None:
            yield pd.DataFrame({"h": range(horizon), "cells": [m.tobytes() for m in total]})

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for h, cells in zip(batch["h"], batch["cells"]):
                one = np.frombuffer(cells)
                total[h] = total[h] + one if h in total else one
        yield pd.DataFrame({"h": list(total), "cells": [m.tobytes() for m in total.values()]})

    schema = "h int, cells binary"
    plain = samples.select(F.col("x").cast("array<double>").alias("x"), F.col("y").cast("array<double>").alias("y"))
    sums = plain.mapInPandas(products, schema).repartition(horizon, "h").mapInPandas(added, schema)
    out = {r["h"]: np.frombuffer(r["cells"]) for r in sums.collect()}
    return {h: m.reshape(int(np.sqrt(len(m))), -1) for h, m in out.items()}


def fit_decomposed(
    samples: DataFrame,
    horizon: int = 24,
    kernel: int = 49,
    peak: float = 5,
    delta: float = 5,
    peak_weight: float = 2,
    least: float = 1.0,
    ridge: float = 1e-6,
    rounds: int = 6,
) -> DataFrame:
    """Maps of the seasonal and of the trend part of ``x`` to every step of ``y``, fitted to the peak-weighted loss.

    The loss is that of ``metrics.peak_huber`` over all samples and steps: the Huber mean of true values of
    ``peak`` and more, ``peak_weight`` fold, plus the mean absolute error of the others, where errors
    below ``least`` count by their square. It is minimised by reweighted least squares: each round sums
    weighted products in one pass and solves one system per step ahead, whose size is that of the input. Both
    blocks are linear in the input, so products are summed for the input alone; ``ridge`` (a share of the mean
    diagonal) picks among equal fits the one with small maps. The samples are written once. Returns the
    model, rows ``(hour, block, step, weight)`` with blocks ``seasonal``, ``trend`` and ``offset``.
    """
    ready = staged(samples.select("x", "y"), "samples")
    spark = ready.sparkSession
    first = ready.agg(F.first(F.size("x")), F.count("*")).first()
    if not first[1]:
        raise ValueError("no samples to fit")
    steps = first[0]
    is_peak = F.size(F.filter("y", lambda v: v >= peak))
    peaks, values = ready.agg(F.sum(is_peak), F.sum(F.size("y"))).first()
    shares = (peak_weight / max(1, peaks), 1 / max(1, values - peaks))
    smooth = moving_mean(steps, kernel)
    # (x, 1) times this is (seasonal, trend, 1)
    blocks = np.zeros((steps + 1, 2 * steps + 1))
    blocks[:steps, :steps], blocks[:steps, steps:-1], blocks[-1, -1] = np.eye(steps) - smooth.T, smooth.T, 1
    solution = None

    def solved(full: np.ndarray) -> np.ndarray:
        gram, right = blocks.T @ full[:, :-1] @ blocks, blocks.T @ full[:, -1]
        penalty = np.r_[np.full(2 * steps, ridge * np.trace(gram) / len(gram)), 0.0]
        return np.linalg.lstsq(gram + np.diag(penalty), right, rcond=None)[0]

    for _ in range(rounds):
        now = None if solution is None else blocks @ solution

        def weigh(x: np.ndarray, y: np.ndarray, now=now) -> np.ndarray:
            if now is None:
                return np.where(y >= peak, shares[0], shares[1])
            return _peak_weights(y - x @ now[:-1] - now[-1], y >= peak, shares, delta, least)

        grams = weighted_grams(ready, weigh, horizon)
        solution = np.stack([solved(grams[h]) for h in range(horizon)], axis=1)
    rows = [
        (h, name, step, float(solution[b * steps + step, h]))
        for h in range(horizon) for b, name in enumerate(BLOCKS) for step in range(steps)
    ] + [(h, "offset", 0, float(solution[-1, h])) for h in range(horizon)]
    return staged(spark.createDataFrame(rows, "hour int, block string, step int, weight double"), "model")


def decomposed_scorer(model: DataFrame, kernel: int = 49, target: int = 0) -> Scorer:
    """Scorer for ``score_sites`` that applies a model of :func:`fit_decomposed` to one channel."""
    table = model.toPandas()
    steps, horizon = (int(table[c].max()) + 1 for c in ("step", "hour"))
    maps = {name: np.zeros((steps, horizon)) for name in BLOCKS}
    offset = np.zeros(horizon)
    for name, part in table.groupby("block"):
        if name == "offset":
            offset[part["hour"]] = part["weight"]
        else:
            maps[name][part["step"], part["hour"]] = part["weight"]
    smooth = moving_mean(steps, kernel)

    def score(x: np.ndarray) -> np.ndarray:
        series = x[:, :, target].astype(np.float64)
        trend = series @ smooth.T
        return ((series - trend) @ maps["seasonal"] + trend @ maps["trend"] + offset)[:, None, :]

    return score


def linear_scorer(weights: np.ndarray, offsets: np.ndarray, target: int = 0) -> Scorer:
    """Scorer for ``score_sites`` that applies a fitted map to one channel."""

    def score(x: np.ndarray) -> np.ndarray:
        return (x[:, :, target].astype(np.float64) @ weights + offsets)[:, None, :]

    return score


def same_hour_mean(per_day: int = 24, channels: Sequence[int] = (0, 1, 2)) -> Scorer:
    """Scorer that repeats the mean day of the input, one target per channel."""

    def score(x: np.ndarray) -> np.ndarray:
        days = x[:, :, list(channels)].astype(np.float64)
        days = days.reshape(len(x), -1, per_day, len(channels)).mean(axis=1)
        return days.transpose(0, 2, 1)

    return score


def score_sites(
    decoded: DataFrame,
    make_scorer: Callable[[], Scorer],
    steps: int,
    width: int,
    targets: Sequence[str] = ("pred_10", "pred_16", "pred_21"),
    key: str = "site_guid",
    column: str = "steps",
    horizon: int = 24,
    batch_mb: float = 64,
) -> DataFrame:
    """Score every site; one ``array<double>`` of ``horizon`` values per target.

    ``make_scorer`` runs once per task (load a model there). Its result maps a batch of shape
    (sites, steps, width) to (sites, targets, h); longer forecasts are cut, shorter ones filled
    with zeros. Rows flow in Arrow batches, are scored in parts of about ``batch_mb`` and never gathered.
    """
    rows = max(1, int(batch_mb * 1e6 / (4 * steps * width)))
    schema = ", ".join([f"`{key}` string", *[f"`{t}` array<double>" for t in targets]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = make_scorer()
        for batch in batches:
            for at in range(0, len(batch), rows):
                part = batch.iloc[at : at + rows]
                x = np.stack(part["flat"].to_numpy()).reshape(len(part), steps, width)
                forecast = score(x)
                out = {key: part[key].to_numpy()}
                for i, target in enumerate(targets):
                    out[target] = list(forecast[:, i, :])
                yield pd.DataFrame(out)

    flat = decoded.select(
        F.col(key).cast("string").alias(key), F.flatten(column).cast("array<float>").alias("flat")
    )
    scored = flat.mapInPandas(run, schema)
    return scored.select(key, *[V.fit_length(t, horizon).alias(t) for t in targets])
