"""Trend and seasonal parts, regressions, scoring, graph operators, publishing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.functions import vectors as V
from dockflow.operators import forecast, graph, publish


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("length", [1, 10, 60, 168])
def test_trend_is_a_padded_moving_mean(frame, length):
    values = np.random.default_rng(length).normal(size=length)
    df = frame([("s", i, float(v)) for i, v in enumerate(values)], "s string, t int, v double")
    out = forecast.trend_seasonal(df, ["s"], "t", "v").orderBy("t").collect()
    padded = np.concatenate([[values[0]] * 24, values, [values[-1]] * 24])
    expected = np.convolve(padded, np.ones(49) / 49, "valid")
    np.testing.assert_allclose([r.trend for r in out], expected, atol=1e-12)
    np.testing.assert_allclose([r.trend + r.seasonal for r in out], values, atol=1e-12)


def test_lag_regression_finds_the_line(frame):
    rows = [("a", t, float(t % 5)) for t in range(20)] + [("b", t, 2.0**t) for t in range(10)]
    out = forecast.lag_regression(frame(rows, "s string, t int, v double"), "s", "t", "v", 1)
    b = {r.s: r for r in out.collect()}["b"]
    assert (b.slope, b.intercept, b.rows) == (pytest.approx(2.0), pytest.approx(0.0), 9)


def _linear_data(frame, n=60, p=5, h=3):
    rng = np.random.default_rng(0)
    x, w, b = rng.normal(size=(n, p)), rng.normal(size=(p, h)), rng.normal(size=h)
    y = x @ w + b + 0.1 * rng.normal(size=(n, h))
    df = frame(
        [(str(i), x[i].tolist(), y[i].tolist()) for i in range(n)],
        "site_guid string, x array<double>, y array<double>",
    )
    return df, x, y


def test_linear_fit_is_least_squares(frame):
    df, x, y = _linear_data(frame)
    weights, offsets = forecast.fit_linear(df, "x", "y", 3)
    solution = np.linalg.lstsq(np.c_[x, np.ones(len(x))], y, rcond=None)[0]
    np.testing.assert_allclose(weights, solution[:-1], atol=1e-6)
    np.testing.assert_allclose(offsets, solution[-1], atol=1e-6)


def test_ridge_spares_the_constant(frame):
    df, x, y = _linear_data(frame)
    weights, offsets = forecast.fit_linear(df, "x", "y", 3, ridge=0.5)
    centred = x - x.mean(0)
    gram = centred.T @ centred + 0.5 * len(x) * np.eye(x.shape[1])
    expected = np.linalg.solve(gram, centred.T @ (y - y.mean(0)))
    np.testing.assert_allclose(weights, expected, atol=1e-6)
    np.testing.assert_allclose(offsets, y.mean(0) - x.mean(0) @ expected, atol=1e-6)


def test_a_week_of_inputs_against_least_squares(frame):
    df, x, y = _linear_data(frame, n=400, p=168, h=24)
    weights, offsets = forecast.fit_linear(df.repartition(5), "x", "y", 24)
    solution = np.linalg.lstsq(np.c_[x, np.ones(len(x))], y, rcond=None)[0]
    np.testing.assert_allclose(weights, solution[:-1], atol=1e-6)
    np.testing.assert_allclose(offsets, solution[-1], atol=1e-6)


def test_linear_scorer_through_scoring(frame):
    df, x, _ = _linear_data(frame)
    weights, offsets = np.arange(10.0).reshape(5, 2), np.array([1.0, -1.0])
    steps = df.select("site_guid", F.transform("x", lambda v: F.array(v, F.lit(9.0))).alias("steps"))
    out = forecast.score_sites(
        steps, lambda: forecast.linear_scorer(weights, offsets), 5, 2, targets=("p",), horizon=4
    ).collect()
    assert len(out) == len(x)
    for r in out:
        expected = x[int(r.site_guid)].astype(np.float32) @ weights + offsets
        np.testing.assert_allclose(r.p, [*expected, 0.0, 0.0], atol=1e-5)


def test_scorer_is_made_once_per_task_and_sees_batches(spark):
    steps = spark.range(100, numPartitions=3).select(
        F.col("id").cast("string").alias("site_guid"),
        F.array(*[F.array(F.col("id").cast("double"), F.lit(1.0), F.lit(2.0))] * 48).alias("steps"),
    )
    out = forecast.score_sites(steps, forecast.same_hour_mean, 48, 3).collect()
    assert len(out) == 100
    assert all(r.pred_10 == [float(r.site_guid)] * 24 and r.pred_21 == [2.0] * 24 for r in out)


def test_hops_are_matrix_products(frame):
    rng = np.random.default_rng(1)
    nodes, times = 6, 9
    x = rng.normal(size=(nodes, times))
    a = rng.random((nodes, nodes)) * (rng.random((nodes, nodes)) < 0.5)
    values = frame(
        [(str(n), t, float(x[n, t])) for n in range(nodes) for t in range(times)],
        "node string, t int, v double",
    )
    edges = frame(
        [(str(i), str(j), float(a[i, j])) for i in range(nodes) for j in range(nodes) if a[i, j]],
        "src string, dst string, weight double",
    )
    for per_part in (2, 1000):
        out = graph.khop(values, [edges], "node", "t", "v", 2, per_part).collect()
        assert len(out) == nodes * times
        one = a.T @ x
        for r in out:
            n = int(r.node)
            assert r.v_hop1 == pytest.approx(one[n, r.t])
            assert r.v_hop2 == pytest.approx((a.T @ one)[n, r.t])
    two = graph.khop(values, [edges, edges], "node", "t", "v", 1)
    assert two.columns == ["node", "t", "v", "v_hop1_s0", "v_hop1_s1"]
    assert two.filter("abs(v_hop1_s0 - v_hop1_s1) > 1e-12").count() == 0


def test_softmax_rows_sum_to_one_and_shift_matters(frame):
    logits = np.random.default_rng(2).normal(size=(4, 4))
    df = frame(
        [(i, j, float(logits[i, j])) for i in range(4) for j in range(4)], "src int, dst int, logit double"
    )
    for shift, axis in (("src", 1), ("dst", 0)):
        z = np.exp(logits - logits.max(axis=axis, keepdims=True))
        expected = z / z.sum(axis=1, keepdims=True)
        for r in graph.edge_softmax(df, "logit", shift=shift).collect():
            assert r.attention == pytest.approx(expected[r.src, r.dst])


FORECASTS = [
    ("1", [-0.5, 0.0, 0.2] + [1.0] * 21, [2.0] * 20, [3.1] * 30),
    ("9", [1.5] * 24, [0.0] * 24, [5.0] * 24),
]


def _forecasts(frame):
    return frame(FORECASTS, "id string, pred_10 array<double>, pred_16 array<double>, pred_21 array<double>")


def test_whole_counts(frame):
    out = {r.id: r for r in publish.whole_counts(_forecasts(frame)).collect()}
    assert out["1"].pred_10 == [0, 0, 1] + [1] * 21
    assert out["1"].pred_16 == [2] * 20 + [0] * 4
    assert out["1"].pred_21 == [4] * 24
    assert out["9"].pred_10 == [2] * 24


def test_hourly_rows_take_the_city_of_fences_in_service(frame):
    fences = frame(
        [("1", "c1", 5, 207, "20240101"), ("9", "c9", 1, 207, "20240101"), ("1", "old", 5, 207, "20231231")],
        "fence_id string, city_guid string, area_status int, area_type int, pt string",
    )
    rows = publish.hourly_rows(
        publish.whole_counts(_forecasts(frame)), publish.current_fences(fences, "20240101")
    )
    assert rows.columns == ["parking_guid", "city_guid", "pred_10", "pred_16", "pred_21", "hour"]
    out = {(r.parking_guid, r.hour): r for r in rows.collect()}
    assert len(out) == 48
    assert out["1", "00"].city_guid == "c1" and out["9", "23"].city_guid is None
    assert (out["1", "02"].pred_10, out["1", "20"].pred_16) == (1, 0)
    assert _rows(publish.city_fences(fences, "20231231", "20240101")) == [("c1",), ("old",)]


def test_hourly_rows_need_no_join_between_targets(frame):
    fences = frame([], "fence_id string, city_guid string")
    plan = publish.hourly_rows(publish.whole_counts(_forecasts(frame)), fences)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join ") == 1 and text.count("Generate ") == 1


def test_json_rows(frame):
    row = publish.json_rows(publish.whole_counts(_forecasts(frame)).filter("id = '9'")).first()
    assert row.period_10_netout_json == '{"period_10_netout":[' + ",".join(["2"] * 24) + "]}"
    fewer = publish.json_rows(_forecasts(frame).drop("pred_16"))
    assert fewer.columns == ["id", "period_10_netout_json", "period_21_netout_json"]


def test_channels(frame):
    df = frame([([[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]],)], "x array<array<double>>")
    row = df.select(V.channel("x", 1), V.channels("x", 0, 2), V.from_json(V.to_json("x"))).first()
    assert row[0] == [2.0, 5.0] and row[1] == [[1.0, 2.0], [4.0, 5.0]]
    assert row[2] == [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]]


def test_decomposed_fit_equals_a_plain_one(spark):
    rng = np.random.default_rng(3)
    n, steps, horizon, kernel = 120, 12, 3, 5
    x = rng.poisson(4, (n, steps)).astype(float)
    y = x[:, -horizon:] * 0.7 + x.mean(axis=1, keepdims=True) + rng.standard_t(2, (n, horizon))
    df = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(x, y)], "x array<double>, y array<double>")
    model = forecast.fit_decomposed(df.repartition(3), horizon, kernel, rounds=5)
    padded = np.c_[np.repeat(x[:, :1], 2, axis=1), x, np.repeat(x[:, -1:], 2, axis=1)]
    trend = np.stack([padded[:, i : i + kernel].mean(axis=1) for i in range(steps)], axis=1)
    z = np.c_[x - trend, trend, np.ones(n)]
    shares = (2 / (y >= 5).sum(), 1 / (y < 5).sum())
    want = np.zeros((n, horizon))
    for h in range(horizon):
        w = np.where(y[:, h] >= 5, *shares)
        for _ in range(5):
            gram = z.T @ (w[:, None] * z)
            penalty = np.r_[np.full(2 * steps, 1e-6 * np.trace(gram) / len(gram)), 0]
            want[:, h] = z @ np.linalg.solve(gram + np.diag(penalty), z.T @ (w * y[:, h]))
            e = np.abs(y[:, h] - want[:, h])
            w = np.where(y[:, h] >= 5, shares[0] * np.minimum(1, 5 / np.maximum(e, 5)), shares[1] / np.maximum(e, 1))
    got = forecast.decomposed_scorer(model, kernel)(x[:, :, None].astype(np.float32))[:, 0, :]
    np.testing.assert_allclose(got, want, rtol=1e-6, atol=1e-6)
    assert {(r.block, r["count"]) for r in model.groupBy("block").count().collect()} == {
        ("seasonal", 36), ("trend", 36), ("offset", 3),
    }
    with pytest.raises(ValueError):
        forecast.fit_decomposed(df.limit(0))


def test_reweighting_lowers_the_loss(spark):
    rng = np.random.default_rng(5)
    x = rng.poisson(6, (400, 1)).astype(float)
    y = 1.5 * x + 1 + np.where(rng.random((400, 1)) < 0.1, 60, 0) * rng.random((400, 1))  # a tenth is far off
    df = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(x, y)], "x array<double>, y array<double>")

    def loss(rounds: int) -> float:
        e = y - forecast.decomposed_scorer(forecast.fit_decomposed(df, 1, 1, rounds=rounds), 1)(x[:, :, None])[:, 0, :]
        peak, size = y >= 5, np.abs(e)
        huber = np.where(size <= 5, size**2 / 2, 5 * (size - 2.5))
        return 2 * huber[peak].mean() + size[~peak].mean()

    assert loss(8) < 0.95 * loss(1)
    slope = forecast.fit_decomposed(df, 1, 1, rounds=8).filter("block = 'trend'").first().weight
    assert slope == pytest.approx(1.5, abs=0.1)
