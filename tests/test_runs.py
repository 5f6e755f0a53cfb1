"""Whole runs over day-partitioned copies of the test tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.operators import features, forecast
from dockflow.plans import queries as q
from dockflow.plans import runs
from dockflow.sources import adapters as td

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def places(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse_days")
    frames = {
        "orders": (
            td.orders(spark, SF_DIR).withColumnsRenamed(
                {"site_guid": "bike_start_park_guid", "capacity": "start_parking_capacity"}
            ),
            "pt",
        ),
        "labels": (td.hourly_labels(spark, SF_DIR), "pt"),
        "snapshots": (td.vehicle_snapshots(spark, SF_DIR), "pt"),
        "weather": (td.weather_workday(spark, SF_DIR), None),
        "fences": (
            td.fence_dim(spark, SF_DIR).withColumn("pt", F.explode(F.array(F.lit("20240130"), F.lit("20240131")))),
            "pt",
        ),
    }
    sources = {}
    for name, (df, day) in frames.items():
        sources[name] = str(root / name)
        writer = df.coalesce(1).write
        (writer.partitionBy(day) if day else writer).parquet(sources[name])
    return runs.Places(sources, str(root / "out"))


LIMITS = runs.Thresholds(q.MAX_ORDERS, q.MAX_ORDERS, q.MEAN_ORDERS)


def _cells(df):
    return sorted(tuple(r) for r in df.collect())


def test_daily_run(spark, places):
    written = runs.write_predict_features(spark, places, "20240201", steps=q.PREDICT_STEPS, limits=LIMITS)
    expected = q.QUERIES["packed_sequences"](spark, SF_DIR)
    assert _cells(written.select("site_guid", "features")) == _cells(expected)

    def nearly_last_day():
        def score(x):
            assert x.dtype == np.float32
            return x[:, -24:, :3].transpose(0, 2, 1) + 0.25

        return score

    out = runs.score_and_publish(spark, places, "20240201", nearly_last_day, q.PREDICT_STEPS)
    sites = written.count()
    assert out["rejected_features"].count() == 0
    assert out["forecasts"].count() == out["json_predictions"].count() == sites
    assert out["hourly_predictions"].count() == sites * 24
    again = runs.score_and_publish(spark, places, "20240201", nearly_last_day, q.PREDICT_STEPS)
    assert again["hourly_predictions"].count() == sites * 24
    # a wrong width sends every site to quarantine
    bad = runs.score_and_publish(spark, places, "20240201", forecast.same_hour_mean, q.PREDICT_STEPS, 23)
    assert {r.reject_reason for r in bad["rejected_features"].collect()} == {"bad_width"}
    assert bad["forecasts"].count() == 0


def test_daily_run_on_tables(spark, places):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    spark.sql("CREATE DATABASE IF NOT EXISTS results")
    for name, path in places.sources.items():
        df = spark.read.parquet(path)
        days = [c for c in df.columns if c == "pt"]
        df = df.withColumns({c: F.col(c).cast("string") for c in days})
        (df.write.partitionBy(*days) if days else df.write).saveAsTable(f"lake.{name}")
    tables = runs.Places({n: f"lake.{n}" for n in places.sources}, "results", None)
    written = runs.write_predict_features(spark, tables, "20240201", steps=q.PREDICT_STEPS, limits=LIMITS)
    expected = q.QUERIES["packed_sequences"](spark, SF_DIR)
    assert _cells(written.select("site_guid", "features")) == _cells(expected)
    out = runs.score_and_publish(spark, tables, "20240201", forecast.same_hour_mean, q.PREDICT_STEPS - 16)
    assert {r.reject_reason for r in out["rejected_features"].collect()} == {"bad_length"}
    assert spark.table("results.predict_features").columns == ["site_guid", "features", "pt"]


def test_training_run(spark, places):
    written = runs.write_training_features(
        spark, places, "20240130", "20240131", 4, q.TRAIN_STEPS, q.DAILY_STEPS, LIMITS
    )
    expected = q.QUERIES["sequence_join"](spark, SF_DIR)
    columns = ["site_guid", "city_guid", "hourly_features"]
    assert _cells(written.select(columns)) == _cells(expected.select(columns))
    assert written.filter("static_features is null").count() == 0
    out = runs.export_batches(
        spark,
        places,
        "20240131",
        batch_size=4,
        hourly_shape=(q.TRAIN_STEPS, len(features.TRAIN_COLUMNS)),
        static_shape=(q.DAILY_STEPS, len(features.DAILY_COLUMNS)),
    )
    total = written.count()
    sums = out["alignment"].agg(F.sum("both"), F.sum("hourly_only"), F.sum("static_only")).first()
    assert tuple(sums) == (total, 0, 0)
    assert out["alignment"].count() == -(-total // 4)
    assert runs.merge_batches(out["batches_hourly"], out["batches_static"]).count() == total


def test_open_run(spark, tmp_path):
    rides = td.rides(spark, SF_DIR).select(
        "ride_id",
        *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("started_at", "ended_at")],
        "start_station_id",
        "end_station_id",
    )
    rides.repartition(3).write.option("header", True).csv(str(tmp_path / "rides"))
    span = runs.OpenRange(
        td.PANEL_START, td.PANEL_END, q.PANEL_CUTOFF, *q.BUSY_RANGE, q.MEAN_ORDERS, q.LAG_CUTOFF, q.DAY_SPLITS
    )
    out = runs.prepare_open_rides(spark, f"{tmp_path}/rides/*.csv", str(tmp_path / "out"), span)
    mine = out["sequences"].select("station_id", F.to_json("features"))
    assert _cells(mine) == _cells(q.QUERIES["panel_sequences"](spark, SF_DIR).select("station_id", "features"))
    assert out["panel"].count() == td.STATIONS * 29 * 24

    kept = out["lagged"].filter(F.col("hour") >= F.lit(q.LAG_CUTOFF).cast("timestamp_ntz"))
    graph = runs.write_graph_splits(kept, str(tmp_path / "graph"), 48, 12)
    samples = 16 * 24 - 48 - 12 + 1
    counts = {r.split: r["count"] for r in graph.groupBy("split").count().collect()}
    stations = out["sequences"].count()
    assert sum(counts.values()) == samples * stations
    assert counts["train"] == round(samples * 0.6) * stations

    daily = runs.daily_training_sets(out["sequences"], 3, {"train": (0, 12), "val": (8, 16)}, 0.5)
    counts = {r.split: r["count"] for r in daily.groupBy("split").count().collect()}
    assert counts == {"train": int(0.5 * 6 * stations), "val": 2 * stations}
