"""Hourly flow, dense panel, forward sums, keys."""

from datetime import date, datetime

from pyspark.sql import functions as F

from dockflow.functions import keys as K
from dockflow.operators import flow

RIDES = "started_at timestamp_ntz, ended_at timestamp_ntz, start_station_id string, end_station_id string"
AT = datetime(2024, 3, 10, 2, 35)  # an hour that some time zones skip


def _rides(frame):
    return frame(
        [
            (AT, AT.replace(hour=3), "a", "b"),
            (AT, AT.replace(hour=3), "a", "b"),
            (AT, None, "b", None),
            (None, AT, None, "b"),
            (AT, AT.replace(hour=4), None, "c"),
        ],
        RIDES,
    )


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_flow_equals_outer_merge_of_counts(frame):
    rides = _rides(frame)
    merged = flow.merge_flows(flow.hourly_inflow(rides), flow.hourly_outflow(rides))
    assert _rows(flow.hourly_flow(rides)) == _rows(merged)
    assert ("b", datetime(2024, 3, 10, 3), 2, 0) in _rows(merged)


def test_missing_station_can_be_kept(frame):
    stations = {r.station_id for r in flow.hourly_flow(_rides(frame), keep_unknown=True).collect()}
    assert stations == {"a", "b", "c", "nan"}


def test_floor_hour_and_keys_do_not_depend_on_the_session_zone(spark, frame):
    df = frame([(AT,)], "at timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = df.select(
            K.floor_hour("at"), K.day_key("at"), K.hour_key(K.day_key("at"), F.hour("at"))
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == (datetime(2024, 3, 10, 2), "20240310", "2024031002")


def test_panel_has_every_station_and_hour(frame):
    rides = _rides(frame)
    panel = flow.dense_panel(flow.hourly_flow(rides), "2024-03-10 00:00:00", "2024-03-10 23:00:00")
    assert panel.count() == 3 * 24
    assert panel.agg(F.sum("inflow")).first()[0] == 4
    assert panel.groupBy("station_id", "hour").count().filter("count > 1").count() == 0


def test_panel_keeps_stations_seen_outside_the_range_only(frame):
    panel = flow.dense_panel(
        flow.hourly_flow(_rides(frame)), "2024-03-11 00:00:00", "2024-03-11 01:00:00"
    )
    assert _rows(panel.groupBy("station_id").agg(F.count("*"), F.sum("outflow"))) == [
        ("a", 2, 0),
        ("b", 2, 0),
        ("c", 2, 0),
    ]


def test_forward_sum_needs_all_rows(frame):
    hours = [("s", datetime(2024, 1, 1, h), h, 1) for h in range(14)]
    short = [("t", datetime(2024, 1, 1, h), 1, 1) for h in range(11)]
    panel = frame(hours + short, "station_id string, hour timestamp_ntz, inflow long, outflow long")
    out = {(r.station_id, r.hour.hour): r for r in flow.future_flow(panel).collect()}
    assert out["s", 0].future_12h_inflow == sum(range(12))
    assert out["s", 2].future_12h_netflow == sum(range(2, 14)) - 12
    assert out["s", 3].future_12h_inflow is None
    assert all(out["t", h].future_12h_inflow is None for h in range(11))


def test_cutoff_is_inclusive_and_range_half_open(frame):
    df = frame([(datetime(2024, 1, 1, h),) for h in range(4)], "hour timestamp_ntz")
    kept = flow.time_range(df, "hour", "2024-01-01 01:00:00", "2024-01-01 03:00:00")
    assert [r.hour.hour for r in kept.orderBy("hour").collect()] == [1, 2]


def test_key_arithmetic(frame):
    df = frame([("20240301", 7)], "pt string, hour int")
    row = df.select(
        K.hour_key("pt", "hour"),
        K.shift_day_key("pt", -1),
        K.shifted_hour_key("pt", "hour"),
        K.day_of_key(F.lit("2024030107")).cast("string"),
        K.weekday_monday0(K.day_of_key("pt")),
        K.weekday_sunday1(K.day_of_key("pt")),
        K.weekday_name(K.day_of_key("pt")),
    ).first()
    assert tuple(row) == ("2024030107", "20240229", "2024022807", "2024-03-01", 4, 6, "Friday")
    assert K.day_text(K.days_after(date(2024, 3, 1), -1)) == "20240229"


def test_run_dates():
    texts = lambda *days: tuple(map(K.day_text, days))
    predict = K.RunDates.predict("20250917")
    assert texts(predict.end, predict.start, predict.warm_up_start) == ("20250915", "20250902", "20250822")
    assert texts(predict.tomorrow, predict.yesterday) == ("20250918", "20250916")
    assert texts(*predict.weather_days) == ("20250904", "20250917")
    train = K.RunDates.train(date(2025, 10, 20))
    assert texts(train.start, train.end, train.label_start, train.label_end) == (
        "20250909",
        "20251020",
        "20250923",
        "20251018",
    )
    assert (train.label_end - train.label_start).days + 1 == 26
    assert texts(*train.fence_days, *train.label_weather_days) == (
        "20251010", "20251020", "20250924", "20251019",
    )


def test_lenient_timestamp(frame):
    df = frame([("2024-01-01 10:00:00.5",), ("bad",), (None,)], "t string")
    assert [r[0] for r in df.select(K.lenient_timestamp("t")).collect()] == [
        datetime(2024, 1, 1, 10, 0, 0, 500000),
        None,
        None,
    ]


def test_spine_length(spark):
    hours = K.hour_spine("2025-04-01 00:00:00", "2025-08-31 23:00:00")
    assert spark.range(1).select(F.size(hours)).first()[0] == 3672
