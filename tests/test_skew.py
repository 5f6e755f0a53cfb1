"""One user and one station hold a third of the events: plans stay bounded and results equal."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.functions import keys as K
from dockflow.operators import flow, graph
from dockflow.sources import adapters as td


def _events(spark, path, n=20000):
    draw = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1000)) / 1000
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    # several events share a second, so the event id decides
    second = F.floor(F.col("id") / n * 86400 * 3)
    k = F.when(draw(3) < 0.33, 7).otherwise(F.floor(draw(4) * 100))
    spark.range(0, n, 1, 4).select(
        F.col("id").alias("event_id"),
        (start + F.make_dt_interval(secs=second.cast("decimal(18,6)"))).alias("ts"),
        F.when(draw(1) < 0.33, 0).otherwise(F.floor(draw(2) * 500)).cast("bigint").alias("user_id"),
        F.lit("view").alias("event_type"),
        draw(5).cast("double").alias("value"),
        F.format_string('{"k": %d}', k.cast("int")).alias("props"),
    ).write.parquet(f"{path}/events.parquet")


def test_rides_equal_one_window_per_user(spark, tmp_path):
    _events(spark, str(tmp_path))
    mine = td.rides(spark, str(tmp_path)).select("ride_id", "ended_at", "end_station_id")
    whole = W.partitionBy("user_id").orderBy("ts", "event_id")
    plain = td.departures(spark, str(tmp_path)).select(
        F.col("event_id").alias("ride_id"),
        F.lead("ts").over(whole).alias("ended_at"),
        F.lead("start_station_id").over(whole).alias("end_station_id"),
    )
    assert mine.exceptAll(plain).count() == 0 and plain.exceptAll(mine).count() == 0

    panel = flow.dense_panel(flow.hourly_flow(td.rides(spark, str(tmp_path))), td.PANEL_START, td.PANEL_END)
    assert panel.count() == td.STATIONS * td.DAYS * 24
    assert panel.agg(F.sum("outflow")).first()[0] == 20000


def test_no_cross_join_and_no_window_over_raw_rides(spark):
    df = flow.future_flow(td.panel(spark, "/root/testdata/sf0.01"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Exchange SinglePartition" not in plan


def test_no_task_gets_a_heavy_user_whole(spark, tmp_path):
    """The window over a user's events is split by minute: bounded rows per (user, minute)."""
    _events(spark, str(tmp_path))
    rides = td.rides(spark, str(tmp_path))
    plan = rides._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "lag(" in line]
    assert windows and all("rider" in w and "bucket" in w for w in windows)
    heaviest = (
        td.departures(spark, str(tmp_path))
        .groupBy("user_id", K.floor_minute("ts")).count().agg(F.max("count")).first()[0]
    )
    assert heaviest <= 20  # of 6,600 events of the user


def test_events_without_a_user_have_no_next_stop(spark, tmp_path):
    _events(spark, str(tmp_path / "all"), 400)
    events = spark.read.parquet(f"{tmp_path}/all/events.parquet")
    events.withColumn("user_id", F.when(F.col("user_id") > 0, F.col("user_id"))).write.parquet(f"{tmp_path}/events.parquet")
    lone = events.filter("user_id = 0").select(F.col("event_id").alias("ride_id"))
    rides = td.rides(spark, str(tmp_path)).join(lone, "ride_id")
    assert rides.count() == lone.count() > 50 and rides.filter("ended_at IS NOT NULL").count() == 0


def test_rides_read_the_events_once(spark):
    from dockflow.plans.queries import QUERIES

    for name in ("dense_panel", "ride_nulls", "outflow_histogram"):
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert (plan.count("FileScan"), plan.count("ReusedExchange")) == (1, 1), name


def test_a_hub_with_a_third_of_the_edges_is_cut_by_its_degree(spark):
    n = 30_000
    src = F.when(F.col("id") % 3 == 0, "hub").otherwise(F.concat(F.lit("s"), (F.col("id") % 997).cast("string")))
    edges = spark.range(n).select(src.alias("src"), F.concat(F.lit("s"), (F.col("id") % 1009).cast("string")).alias("dst"), F.lit(1.0).alias("weight"))
    cut, hubs = graph.prepare_edges(edges, edges_per_part=500)
    assert hubs.collect() == [("hub", 20)]
    groups = cut.groupBy("src", "part").count().agg(F.max("count"), F.sum("count")).first()
    assert groups[0] < 800 and groups[1] == n
    values = spark.range(5).select(F.lit("hub").alias("node"), F.col("id").alias("t"), F.lit(2.0).alias("v"))
    out = graph.hop(values, (cut, hubs), "node", "t", "v")
    assert out.agg(F.sum("v")).first()[0] == 5 * 2.0 * n / 3
    # rows of the join in the largest task, where tasks are the buckets of (source, part)
    tasks = cut.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert tasks < 0.3 * n
