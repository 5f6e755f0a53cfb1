"""Adapters from the supplied test tables to the schemas of ``schemas.py``.

Stations are the 100 values ``k`` of the events; every event is one ride.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.functions import keys as K
from dockflow.operators import flow
from dockflow.sources.readers import between_days

PANEL_START = "2024-01-01 00:00:00"
PANEL_END = "2024-01-30 23:00:00"
DAYS = 30
STATIONS = 100
CITIES = 5
TARGETS = ("label_10", "label_16", "label_21")


# column types of the tables that are read
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _station() -> Column:
    # props hold the one key k; a pattern reads it about ten times faster than a JSON parser
    return F.regexp_extract("props", r'"k"\s*:\s*(\d+)', 1).try_cast("int").cast("string")


def _with_next_stop(events: DataFrame) -> DataFrame:
    """Every event's ``stop`` and the ``next_stop`` of the same user, by ``(ts, event_id)``.

    A user may own a large share of all events, so the order is not taken over whole users:
    inside (user, minute) buckets by ``lead``, and for the last event of a bucket from the first
    event of the user's next bucket, which is found on one row per (user, minute). Both read one
    shuffle of the events (the same columns), and the join back needs no other. An event
    without a user has no next stop.
    """
    # never null, or the join's null filter on one side would keep the two from sharing the shuffle
    rider = F.coalesce("user_id", -1 - F.col("event_id"), F.lit(-1)).alias("rider")
    minute = F.coalesce(K.floor_minute("ts"), K.ntz("1970-01-01 00:00:00")).alias("bucket")
    stop = F.struct("ts", "event_id", "start_station_id", "ride_type").alias("stop")
    inside = W.partitionBy("rider", "bucket").orderBy("stop")
    stops = events.select(rider, minute, stop).select(
        "*",
        F.lead("stop").over(inside).alias("following"),
        F.lag("stop").over(inside).isNull().alias("is_head"),
    )
    heads = stops.filter("is_head").select(
        "rider",
        "bucket",
        F.lead("stop").over(W.partitionBy("rider").orderBy("bucket")).alias("next_head"),
    )
    return stops.join(heads, ["rider", "bucket"], "left").select(
        "stop", F.coalesce("following", "next_head").alias("next_stop")
    )


def departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides without their end: one row per event."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        F.col("event_type").alias("ride_type"),
        "value",
        _station().alias("start_station_id"),
    )


def ride_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The start columns of ``rides`` alone, which need no look at the next event."""
    return departures(spark, sf_dir).select(
        F.col("event_id").alias("ride_id"),
        "ride_type",
        F.col("ts").alias("started_at"),
        "start_station_id",
    )


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start at the event's station and time, end at those of the user's next event."""
    return _with_next_stop(departures(spark, sf_dir)).select(
        F.col("stop.event_id").alias("ride_id"),
        "stop.ride_type",
        F.col("stop.ts").alias("started_at"),
        F.col("next_stop.ts").alias("ended_at"),
        "stop.start_station_id",
        F.col("next_stop.start_station_id").alias("end_station_id"),
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(station_id, hour, inflow, outflow) for every station and hour."""
    return panel_of(rides(spark, sf_dir))


def panel_of(found: DataFrame) -> DataFrame:
    return flow.dense_panel(flow.hourly_flow(found), PANEL_START, PANEL_END)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return departures(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("start_station_id").alias("site_guid"),
        F.floor("value").alias("capacity"),
        K.day_key("ts").alias("pt"),
    )


def city_of(station: str) -> Column:
    return (F.col(station).cast("int") % CITIES).cast("string")


def hourly_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net outflow of this hour and of 6 and 12 hours ahead, at hours with a departure only."""
    net = panel(spark, sf_dir).withColumn("net", F.col("outflow") - F.col("inflow"))
    ahead = flow.forward_sums(net, {"label_16": "net"}, 6, complete=False)
    ahead = flow.forward_sums(ahead, {"label_21": "net"}, 12, complete=False)
    return ahead.filter("outflow > 0").select(
        F.col("station_id").alias("site_guid"),
        city_of("station_id").alias("city_guid"),
        F.col("net").cast("double").alias("label_10"),
        F.col("label_16").cast("double").alias("label_16"),
        F.col("label_21").cast("double").alias("label_21"),
        F.hour("hour").alias("hour"),
        K.day_key("hour").alias("pt"),
    )


def vehicle_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = {"put_veh_cnt": "view", "idle_12h_cnt": "error", "idle_1d_cnt": "click"}
    return (
        departures(spark, sf_dir)
        .groupBy(
            F.col("start_station_id").alias("parking_guid"),
            K.day_key("ts").alias("pt"),
            K.two_digits(F.hour("ts")).alias("hr"),
            F.when(F.minute("ts") < 30, "00").otherwise("30").alias("min"),
        )
        .agg(*[F.count_if(F.col("ride_type") == v).alias(c) for c, v in counts.items()])
    )


def weather_workday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two forecasts per (city, day): made for one and for two days later, the second warmer."""
    day = F.col("day")
    per_day = (
        departures(spark, sf_dir)
        .groupBy(city_of("start_station_id").alias("city_guid"), F.col("ts").cast("date").alias("day"))
        .agg(
            (F.count_if(F.col("ride_type") == "signup") % 4).cast("int").alias("cycle_weather_level"),
            F.round(F.avg("value"), 1).alias("mean_value"),
        )
    )
    workday = (
        F.when(F.weekday(day) == 6, 0).when(F.weekday(day) == 5, 2).otherwise(1).cast("int")
    )
    ahead = F.explode(F.array(F.lit(1), F.lit(2))).alias("ahead")
    return per_day.select("*", ahead).select(
        "city_guid",
        K.day_key(day).alias("forecast_date"),
        K.day_key(F.date_add(day, F.col("ahead"))).alias("pred_date"),
        "cycle_weather_level",
        F.round(F.col("mean_value") + (F.col("ahead") - 1), 1).alias("temperature_avg_val"),
        workday.alias("workday_level"),
    )


def fence_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("fence_id"),
        (F.col("s_nationkey") % CITIES).cast("string").alias("city_guid"),
        F.when(F.col("s_acctbal") > 0, 5).otherwise(1).alias("area_status"),
        F.lit(207).alias("area_type"),
        F.lit("20240131").alias("pt"),
    )


def known_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities with a code; one city of the orders is not among them."""
    nation = table(spark, sf_dir, "nation")
    return nation.select((F.col("n_nationkey") % (CITIES - 1)).cast("string").alias("city_guid")).distinct()


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of the rides of ``src`` that end at ``dst``."""
    return edges_of(rides(spark, sf_dir))


def edges_of(found: DataFrame) -> DataFrame:
    pairs = (
        found
        .groupBy(F.col("start_station_id").alias("src"), F.col("end_station_id").alias("dst"))
        .agg(F.count("*").alias("n"))
    )
    share = F.col("n") / F.sum("n").over(W.partitionBy("src"))
    return pairs.withColumn("weight", share).dropna(subset=["dst"]).select("src", "dst", "weight")


def encoded_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 8 x 8 JSON matrices, some of them damaged.

    Every 7th misses its last step, every 11th has one short step, every 13th holds a null, every
    17th is cut off in the middle of the text.
    """
    flat = F.transform("embedding", lambda x: F.round(x.cast("double"), 4))
    step = lambda i: F.slice(F.col("flat"), i * 8 + 1, 8)
    whole = F.transform(F.sequence(F.lit(0), F.lit(7)), step)
    ragged = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda i: F.slice(F.col("flat"), i * 8 + 1, F.when(i == 3, 7).otherwise(8)),
    )
    holed = F.transform(
        whole, lambda s, i: F.when(i == 5, F.transform(s, lambda v, j: F.when(j != 2, v))).otherwise(s)
    )
    every = lambda n: F.col("vec_id") % n == n - 1
    matrix = (
        F.when(every(7), F.slice(whole, 1, 7))
        .when(every(11), ragged)
        .when(every(13), holed)
        .otherwise(whole)
    )
    text = F.to_json(matrix)
    return (
        table(spark, sf_dir, "embeddings")
        .select("vec_id", flat.alias("flat"))
        .select(
            F.col("vec_id").cast("string").alias("site_guid"),
            F.when(every(17), F.substring(text, 1, 40)).otherwise(text).alias("features"),
        )
    )


def flow_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense hourly steps (station_id, hour, net_flow, inflow, outflow, hour_of_day)."""
    return panel(spark, sf_dir).select(
        "station_id",
        "hour",
        (F.col("inflow") - F.col("outflow")).alias("net_flow"),
        "inflow",
        "outflow",
        F.hour("hour").alias("hour_of_day"),
    )


FLOW_FEATURES = ("net_flow", "inflow", "outflow", "hour_of_day")


def forecast_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward 12 h sums against their values a day earlier plus a half, for three targets."""
    ahead = flow.future_flow(panel(spark, sf_dir))
    by_station = W.partitionBy("station_id").orderBy("hour")
    truth = F.array("future_12h_outflow", "future_12h_inflow", "future_12h_netflow")
    earlier = F.lag("truth", 24).over(by_station)
    return (
        ahead.select("station_id", "hour", truth.alias("truth"))
        .withColumn("earlier", earlier)
        .select(
            F.col("station_id").alias("site"),
            "hour",
            F.posexplode(F.arrays_zip("truth", "earlier")).alias("target", "v"),
        )
        .select(
            "site",
            "target",
            (F.datediff(F.col("hour").cast("date"), F.lit(PANEL_START).cast("date")) - 1).alias("day_idx"),
            F.hour("hour").alias("hour"),
            F.col("v.truth").cast("double").alias("y_true"),
            (F.col("v.earlier") + 0.5).cast("double").alias("y_pred"),
        )
        .dropna()
    )
