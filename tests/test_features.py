"""Sites, lags, defaults, category codes and typed vectors."""

import pytest
from pyspark.sql import functions as F

from dockflow.functions import vectors as V
from dockflow.operators import features, numbering, sites


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_mean_is_over_days_with_orders_and_sets_unite(frame):
    orders = frame(
        [(str(i), s, 1, d) for s, d, n in (("a", "1", 4), ("a", "3", 2), ("b", "1", 1)) for i in range(n)]
        + [(None, "b", 1, "2")],
        "order_id string, site_guid string, capacity long, pt string",
    )
    activity = sites.site_activity(sites.daily_orders(orders))
    # the order without an id still makes a day with count 0
    assert _rows(activity) == [("a", 4, 3.0), ("b", 1, 0.5)]
    one = sites.eligible_sites(activity, max_at_least=4).select("site_guid")
    two = sites.eligible_sites(activity, mean_at_least=0.5).select("site_guid")
    both = sites.eligible_sites(activity, 4, 0.5).select("site_guid")
    assert _rows(sites.either_set(one, two)) == _rows(both)


def test_row_lag_counts_rows_and_calendar_lag_counts_days(frame):
    daily = frame(
        [("s", f"2024010{d}", d) for d in (1, 2, 4, 5, 6, 7)],
        "site_guid string, pt string, daily_order_cnt long",
    )
    rows = {r.pt: r.lag7d_order_cnt for r in features.order_day_lag(daily).collect()}
    days = {r.pt: r.lag7d_order_cnt for r in features.order_day_lag(daily, mode="calendar").collect()}
    assert rows["20240107"] == 1 and rows["20240106"] is None
    assert days["20240107"] == 2 and days["20240106"] == 1
    with pytest.raises(ValueError):
        features.order_day_lag(daily, mode="other")


def test_same_hour_lags_do_not_cross_sites_or_hours(frame):
    df = frame(
        [(s, h, f"2024010{d}", float(d + 10 * h), 0.0, 0.0) for s in "ab" for h in (0, 1) for d in (1, 2, 3)],
        "site_guid string, hour int, pt string, label_10 double, label_16 double, label_21 double",
    )
    out = features.same_hour_lags(df, [1, 2])
    assert len([c for c in out.columns if c.startswith("lag")]) == 6
    for r in out.collect():
        day = int(r.pt[-1])
        assert r.lag1d_10 == (r.label_10 - 1 if day > 1 else None)
        assert r.lag2d_10 == (r.label_10 - 2 if day > 2 else None)


def test_lags_share_one_shuffle(spark, frame):
    df = frame(
        [("a", 0, "20240101", 1.0, 1.0, 1.0)],
        "site_guid string, hour int, pt string, label_10 double, label_16 double, label_21 double",
    )
    plan = features.same_hour_lags(df)._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Exchange") == 1 and initial.count("Window [") == 1


def test_fills(frame):
    df = frame([(None, None, None)], "a int, b double, c string")
    assert tuple(features.fill_numeric(df).first()) == (0, 0.0, None)
    filled = features.fill_defaults(df, {"a": 2, "b": 25.0, "absent": 1})
    assert tuple(filled.first()) == (2, 25.0, None)
    assert filled.schema["a"].dataType == df.schema["a"].dataType


def test_first_per_key_follows_the_order_column(frame):
    df = frame([("k", "2", 1, None), ("k", "1", 2, 5), ("j", "9", 3, 4)], "k string, o string, a int, b int")
    assert _rows(features.one_per_key(df, ["k"], "o", ["a", "b"])) == [("j", 3, 4), ("k", 2, 5)]


def test_city_codes_are_alphabetical_and_unknown_is_next(frame):
    cities = frame([("b",), ("a",), ("c",), ("a",), (None,)], "city_guid string")
    codes = features.city_codes(cities)
    assert _rows(codes) == [("a", 0), ("b", 1), ("c", 2)]
    out = features.encode_city(frame([("c",), ("z",), (None,)], "city_guid string"), codes)
    assert {r.city_guid: r.city_guid_encoded for r in out.collect()} == {"c": 2, "z": 3, None: 3}


def test_static_vector_layout_and_clamping(frame):
    df = frame(
        [(3.0, 10, 20.5, 99, 7, 2, 1)],
        "lag7d_order_cnt double, parking_capacity int, temperature_avg_val double, "
        "city_guid_encoded int, day_of_week int, workday_level int, cycle_weather_level int",
    )
    row = features.static_vector(df, features.feature_types(5)).first()
    # 5 cities + 1 unknown + 10 reserved slots
    assert row.static_vector == [0.0] * 7 + [1.0] + [0.0, 0.0, 1.0] + [15.0, 1.0] + [3.0, 10.0, 20.5]
    assert row.clamped_ids == 1


def test_static_vector_slots_are_size_plus_reserve(frame):
    df = frame([(15,), (16,), (17,)], "c int")
    out = df.select("c", V.clamp_code("c", 16).alias("k"), V.is_clamped("c", 16).alias("m"))
    assert _rows(out) == [(15, 15, False), (16, 15, True), (17, 15, True)]


def test_position_wave_and_decoder_context(frame):
    import numpy as np

    width, pos = 6, 5
    rates = np.exp(np.arange(0, width, 2) * -np.log(10000.0) / width)
    expected = np.empty(width)
    expected[0::2], expected[1::2] = np.sin(pos * rates), np.cos(pos * rates)
    df = frame([(pos, [[float(i), 9.0] for i in range(30)])], "p int, x array<array<double>>")
    got = df.select(*[V.position_wave("p", i, width).alias(f"w{i}") for i in range(width)]).first()
    np.testing.assert_allclose(list(got), expected, atol=1e-12)
    context = df.select(V.decoder_context("x", 24, 24, 2)).first()[0]
    assert context == [[float(i), 0.0] for i in range(6, 30)] + [[0.0, 0.0]] * 24


def test_row_numbers_are_global_and_pages_full(spark):
    df = spark.range(1000, numPartitions=7).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("k"))
    numbered = numbering.row_numbers(df.orderBy(F.rand(1)), ["k"])
    assert all(r.row_id == int(r.k) + 1 for r in numbered.collect())
    paged = numbering.pages(numbered, 64)
    sizes = {r.batch_id: r["count"] for r in paged.groupBy("batch_id").count().collect()}
    assert sizes == {i: 64 for i in range(15)} | {15: 40}
    assert numbering.full_pages_only(numbered, 64).count() == 960
    assert numbering.page(numbered, 1, 64).agg(F.min("row_id"), F.max("row_id")).first()[:] == (65, 128)
    assert numbering.number_rows(df, "k").filter("row_id != cast(k as int) + 1").count() == 0


def test_hash_pages_cover_all(spark):
    df = numbering.hash_pages(spark.range(500), "id", 4)
    assert _rows(df.select("batch_id").distinct()) == [(0,), (1,), (2,), (3,)]


@pytest.mark.parametrize("rows,share", [(1000, 0.4), (1000, 0.0), (1000, 1.0), (7, 0.5), (0, 0.5)])
@pytest.mark.parametrize("digits", [1, 4])
def test_exact_fraction(spark, rows, share, digits):
    df = spark.range(rows).withColumn("x", F.col("id") * 2)
    taken = numbering.fraction_exact(df, ["id"], share, 3, digits)
    again = numbering.fraction_exact(df.repartition(5), ["id"], share, 3, digits)
    assert taken.columns == df.columns
    assert _rows(taken) == _rows(again)
    assert taken.count() == int(share * rows)
    assert taken.distinct().count() == taken.count()
