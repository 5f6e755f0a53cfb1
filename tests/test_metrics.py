"""Error metrics and profiles on small frames with known answers."""

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.operators import metrics, profile

EVAL = "target int, day_idx int, hour int, y_true double, y_pred double"


def _one(df, **where):
    for k, v in where.items():
        df = df.filter(F.col(k) == v)
    return df.first()


def test_threshold_is_strict_in_slices_and_inclusive_per_day(frame):
    df = frame([(0, 0, 8, 5.0, 7.0), (0, 0, 8, 10.0, 9.0), (0, 0, 19, 4.0, 4.0)], EVAL)
    m = _one(metrics.slice_metrics(df), slice="morning")
    assert (m.mse, m.mape, m.wmape, m.rows) == (1.0, pytest.approx(0.1), pytest.approx(0.1), 1)
    d = _one(metrics.daily_metrics(df), slice="morning")
    assert (d.mape, d.wape, d.rows) == (pytest.approx(0.25), pytest.approx(0.2), 2)


def test_slice_without_truth_is_null_and_counted(frame):
    df = frame([(0, 0, 8, 9.0, 9.0), (0, 1, 8, 1.0, 9.0)], EVAL)
    evening = _one(metrics.slice_metrics(df), slice="evening")
    assert (evening.mse, evening.mape, evening.wmape, evening.rows) == (None, None, None, 0)
    mean = _one(metrics.mean_of_days(metrics.daily_metrics(df)), slice="morning")
    assert (mean.mape, mean.empty_days) == (0.0, 1)


def test_daily_forecasts_are_rounded_half_to_even(frame):
    df = frame([(0, 0, 8, 5.0, 2.5), (0, 0, 13, 5.0, 3.5), (0, 0, 19, 5.0, 4.5)], EVAL)
    out = {r.slice: r.mape for r in metrics.daily_metrics(df).collect()}
    assert out["morning"] == pytest.approx(3 / 5)
    assert out["afternoon"] == pytest.approx(1 / 5)
    assert out["evening"] == pytest.approx(1 / 5)


def _peak_huber(t, p):
    e, peak = np.abs(t - p), t >= 5
    h = np.where(e <= 5, 0.5 * e**2, 5 * (e - 2.5))
    return 2 * (h[peak].mean() if peak.any() else 0) + (e[~peak].mean() if (~peak).any() else 0)


def test_losses_against_numpy(frame):
    rng = np.random.default_rng(3)
    t, p = rng.uniform(0, 12, 200), rng.uniform(0, 25, 200)
    target, day = rng.integers(0, 3, 200), rng.integers(0, 4, 200)
    df = frame(
        [(int(a), int(d), 0, float(x), float(y)) for a, d, x, y in zip(target, day, t, p)], EVAL
    )
    assert metrics.peak_huber(df).first().loss == pytest.approx(_peak_huber(t, p))
    losses = {k: _peak_huber(t[target == k], p[target == k]) for k in range(3)}
    weights = {0: 1.0, 2: 3.0}
    for r in metrics.multi_target_loss(df, weights).collect():
        assert r.loss == pytest.approx(losses[r.target])
        assert r.total_loss == pytest.approx(losses[0] + losses[1] + 3 * losses[2])
    o = metrics.overall_error(df).first()
    e = np.abs(t - p)
    assert o.mae == pytest.approx(e.mean()) and o.rmse == pytest.approx(np.sqrt((e**2).mean()))
    assert o.smooth_l1 == pytest.approx(np.where(e < 5, 0.5 * e**2 / 5, e - 2.5).mean())
    batches = [_peak_huber(t[day == k], p[day == k]) for k in range(4)]
    sizes = [(day == k).sum() for k in range(4)]
    a = metrics.averaged_loss(df, "day_idx").first()
    assert a.batch_mean_loss == pytest.approx(np.mean(batches))
    assert a.weighted_mean_loss == pytest.approx(np.average(batches, weights=sizes))


def test_losses_with_an_empty_class(frame):
    assert metrics.peak_huber(frame([(0, 0, 0, 1.0, 3.0)], EVAL)).first().loss == 2.0
    assert metrics.peak_huber(frame([(0, 0, 0, 9.0, 7.0)], EVAL)).first().loss == 4.0


def test_horizons_and_zero_truth(frame):
    df = frame([(0, 0, 0, 0.0, 3.0), (0, 0, 0, 2.0, 3.0), (0, 0, 1, 4.0, 4.0)], EVAL)
    masked = _one(metrics.horizon_metrics(df), hour=0)
    assert (masked.mae, masked.mape, masked.rmse) == (1.0, 0.5, 1.0)
    kept = _one(metrics.horizon_metrics(df, mask_zero=False), hour=0)
    assert (kept.mae, kept.mape) == (2.0, 0.5)
    assert metrics.mean_over_horizons(metrics.horizon_metrics(df)).first().mae == 0.5


RIDES = "started_at timestamp_ntz, ended_at timestamp_ntz, start_station_id string, end_station_id string"


def test_last_bin_holds_its_upper_edge(frame):
    df = frame([(0,), (119,), (120,), (6000,), (None,)], "total_outflow long")
    bins = {r.bin: (r.bin_start, r.bin_end, r["count"]) for r in profile.outflow_histogram(df).collect()}
    assert bins == {0: (0.0, 120.0, 2), 1: (120.0, 240.0, 1), 49: (5880.0, 6000.0, 1)}
    wide = profile.outflow_histogram(frame([(10000,), (1,)], "total_outflow long"))
    assert {r.bin for r in wide.collect()} == {0, 49}
    net = profile.netflow_histogram(frame([(-300,), (0,), (200,)], "net_flow long"))
    values = np.histogram([-300, 0, 200], bins=60, range=(-300, 200))[0]
    assert {r.bin: r["count"] for r in net.collect()} == {i: n for i, n in enumerate(values) if n}


def test_ties_at_the_tenth_place_go_by_station(frame):
    totals = frame([(f"s{i:02d}", 5) for i in range(12)] + [("z", 9)], "station_id string, total_outflow long")
    top = [r.station_id for r in profile.top_stations(totals).collect()]
    assert top == ["z", *[f"s{i:02d}" for i in range(9)]]


def test_station_totals_lose_arrival_only_stations(frame):
    at = datetime(2024, 1, 1, 5)
    rides = frame([(at, at, "a", "b"), (at, at, "a", "c"), (at, None, "b", None)], RIDES)
    out = {r.station_id: tuple(r)[1:] for r in profile.station_totals(rides, 2).collect()}
    assert out == {"a": (2, 0, 1.0, -2), "b": (1, 1, 0.5, 0)}


def test_profiles_keep_absent_values_null(frame):
    monday, tuesday = datetime(2024, 1, 1, 5), datetime(2024, 1, 2, 7)
    rides = frame([(monday, tuesday, "a", "b"), (monday, None, "a", None)], RIDES)
    counts = profile.calendar_counts(rides)
    hours = {r.hour_of_day: (r.outflow, r.inflow) for r in profile.hour_profile(counts).collect()}
    assert hours == {5: (2, None)}
    days = profile.weekday_profile(counts).orderBy("weekday").collect()
    assert [r.day_name for r in days][:2] == ["Monday", "Tuesday"] and len(days) == 7
    assert (days[0].outflow, days[1].inflow, days[2].outflow) == (2, 1, None)
    peaks = {r.kind: r for r in profile.peak_hours(rides).collect()}
    assert (peaks["hour"].busiest, peaks["weekday"].quietest) == ("5", "Monday")


def test_extremes_take_the_first_of_equals(frame):
    df = frame([(3, 5), (1, 5), (2, 1), (4, 1)], "hour_of_day int, outflow long")
    r = profile.extremes(df, "hour_of_day", "hour_of_day").first()
    assert (r.busiest, r.largest, r.quietest, r.smallest) == ("1", 5, "2", 1)


def test_volume_and_counts(frame):
    at = datetime(2024, 1, 1, 5)
    rides = frame([(at, at, "a", "b"), (at, None, "a", None)], RIDES)
    v = profile.volume_stats(profile.daily_volume(rides)).first()
    assert (v.mean_orders, v.max_orders, v.min_orders, v.days) == (1.0, 1, 1, 1)
    assert profile.null_counts(rides).first().ended_at_nulls == 1
    assert profile.value_counts(rides).first().ended_at_values == 1
    assert profile.shape(rides) == (2, 4)
    assert profile.data_range(rides).first().stations == 1
    assert profile.approximate_stations(rides).first().stations == 1
    c = profile.completeness(
        frame([("a", 1), ("a", None), ("b", 1)], "station_id string, x int"), columns=["x"]
    ).first()
    assert (c.keys, c.min_rows, c.max_rows, c.distinct_lengths, c.rows, c.x_nulls) == (2, 1, 2, 2, 3, 1)


def test_preview_puts_nulls_last(frame):
    df = frame([("b",), (None,), ("a",)], "k string")
    assert [r.k for r in profile.preview(df, ["k"], 2).collect()] == ["a", "b"]
    assert [r.k for r in profile.preview(df, ["k"]).collect()] == ["a", "b", None]
    totals = frame([("b", 2), ("a", 2), ("c", 3)], "station_id string, total_outflow long")
    assert [r.station_id for r in profile.by_outflow(totals).collect()] == ["c", "a", "b"]


def test_median_by_refinement(spark, frame):
    import random

    random.seed(4)
    cases = [
        [1], [1, 2], [5] * 9, list(range(1001)), [random.gauss(0, 1) for _ in range(3000)],
        [1e308, -1e308, 3.0, 3.0000000001], [random.random() ** 40 for _ in range(2000)] + [1e300], [None, float("nan"), 2.0, 8.0],
    ]
    for values in cases:
        df = frame([(None if v is None else float(v),) for v in values], "x double")
        known = [v for v in values if v is not None and v == v]
        assert profile.exact_median(df, "x") == float(np.median(known))
    assert profile.exact_median(df.limit(0), "x") is None
    assert profile.value_at_rank(frame([(float(i),) for i in range(5000)], "x double"), "x", 4321, bins=3) == 4321


def test_histogram_of_a_continuous_column(spark):
    df = spark.range(20_000).select((F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1000.0).alias("x"))
    got = profile.histogram(df, "x", 40, low=0, at_least=10)
    assert "collect_list" not in got._jdf.queryExecution().optimizedPlan().toString()
    values = np.array([r.x for r in df.collect()])
    counts, edges = np.histogram(values, 40, (0, values.max()))
    found = {r.bin: r for r in got.collect()}
    assert [found[i]["count"] if i in found else 0 for i in range(40)] == counts.tolist()
    assert found[7].bin_start == pytest.approx(edges[7])
