"""Registered queries on sources and sinks: written to the scratch folder, read back and compared.

Each writes what it derives from the supplied tables with a sink, reads it with a reader and returns what came
back; ``ORACLE`` has the same rows from the tables themselves.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.operators import features, profile, samples, sequences, sites
from dockflow.plans import queries as q
from dockflow.plans.oracle import CTES, _big, _with
from dockflow.sources import adapters as td
from dockflow.sources import files, readers, scratch, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

DAYS = ("20240105", "20240106", "20240107")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _named(spark: SparkSession, folder: str, prefix: str, into: str) -> None:
    """Move a folder's CSV files into another under names that a pattern can tell apart."""
    for i, name in enumerate(sorted(n for n in files.children(spark, folder) if n.endswith(".csv"))):
        files.rename(spark, f"{folder}/{name}", f"{into}/{prefix}-rides-{i}.csv")


@query
def csv_rides(spark, sf_dir):
    """CSV files with their columns in another order and one column more, by pattern, tagged and typed."""
    path = scratch.scratch_path(spark, "csv")
    events = td.departures(spark, sf_dir)
    text = F.when(F.col("event_id") % 9 == 4, "no time").otherwise(F.col("ts").cast("string"))
    rides = events.select(F.col("event_id").alias("ride_id"), text.alias("started_at"), "start_station_id", "ride_type")
    sinks.write_csv(rides.filter("ride_id % 2 = 0").drop("ride_type"), f"{path}/even")
    sinks.write_csv(rides.filter("ride_id % 2 = 1").select("start_station_id", "ride_type", "started_at", "ride_id"), f"{path}/odd")
    sinks.write_csv(rides.filter("ride_id % 2 = 1").limit(9), f"{path}/other")
    for kind in ("even", "odd"):
        _named(spark, f"{path}/{kind}", kind, f"{path}/all")
    _named(spark, f"{path}/other", "other", f"{path}/all/below")
    raw = readers.read_csv_files(spark, f"{path}/all/*-rides-*.csv", ["ride_id", "started_at", "start_station_id", "ride_type"])
    typed = readers.type_rides(raw)
    return typed.select(
        F.col("ride_id").cast("bigint").alias("ride_id"), "started_at", "start_station_id", "ride_type",
        F.regexp_extract(readers.SOURCE_FILE, "^[a-z]+", 0).alias("kind"),
    )


ORACLE["csv_rides"] = _with(
    """SELECT event_id AS ride_id, CASE WHEN event_id % 9 <> 4 THEN ts END AS started_at, station AS start_station_id,
        CASE WHEN event_id % 2 = 1 THEN ride_type END AS ride_type,
        CASE WHEN event_id % 2 = 1 THEN 'odd' ELSE 'even' END AS kind
      FROM departures""",
    "departures",
)


@query
def damaged_csv(spark, sf_dir):
    """One CSV file of suppliers per nation; every third breaks off in its last record, every fourth is Latin-1."""
    path = scratch.scratch_path(spark, "damaged")
    rows = td.table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"),
        F.format_string("%d,Müller,%s", F.col("s_suppkey"), F.col("s_name")).alias("line"),
    )
    nation = F.col("nation") % 12
    kinds = {"cut": nation.isin(0, 3, 6, 9), "latin": nation.isin(4, 8), "good": ~nation.isin(0, 3, 4, 6, 8, 9)}
    for kind, which in kinds.items():
        lines = rows.filter(which).groupBy("nation").agg(F.array_sort(F.collect_list("line")).alias("lines"))
        lines = lines.select("nation", F.concat(F.array(F.lit("id,name,label")), F.col("lines")).alias("lines"))
        if kind == "cut":
            # a whole file is one value here, so that no line end follows its last record
            whole = F.regexp_replace(F.array_join("lines", "\n"), ",[^,\n]*$", "")
            out = lines.select("nation", whole.alias("value")).repartition("nation").write
            out.option("lineSep", "\0").partitionBy("nation").text(f"{path}/{kind}")
        else:
            out = lines.select("nation", F.explode("lines").alias("value")).repartition("nation").write.partitionBy("nation")
            out.option("encoding", "ISO-8859-1" if kind == "latin" else "UTF-8").option("quote", "").csv(f"{path}/{kind}")
    found = readers.damaged_files(spark, [f"{path}/{kind}/*/*" for kind in kinds])
    return found.select(F.regexp_extract("file", r"nation=(\d+)", 1).cast("bigint").alias("nation"), "reason")


ORACLE["damaged_csv"] = """SELECT DISTINCT CAST(s_nationkey AS BIGINT) AS nation,
    CASE WHEN s_nationkey % 3 = 0 THEN 'cut off' ELSE 'not UTF-8' END AS reason
  FROM supplier WHERE s_nationkey % 12 IN (0, 3, 4, 6, 8, 9)"""


def _daily(spark, sf_dir):
    return sites.daily_orders(td.between_days(td.orders(spark, sf_dir), DAYS[0], DAYS[-1]))


def _overwritten(daily: DataFrame, write: Callable) -> None:
    """All days with wrong counts first, then two of them with the right ones, the last one twice."""
    daily = scratch.staged(daily, "daily")
    for day in DAYS:
        write(daily.filter(F.col("pt") == day).withColumn("daily_order_cnt", F.lit(-1).cast("bigint")), day)
    for day in (DAYS[0], DAYS[2], DAYS[2]):
        write(daily.filter(F.col("pt") == day), day)


@query
def day_folders(spark, sf_dir):
    """Day partitions below a path, overwritten one by one, and a range of them read back."""
    path = scratch.scratch_path(spark, "days")
    _overwritten(_daily(spark, sf_dir), lambda df, day: sinks.overwrite_day(df, day, path, order=["site_guid"]))
    return q._tidy(readers.read_days(spark, path, DAYS[1], DAYS[2], "parquet"))


@query
def day_table(spark, sf_dir):
    """The same in a declared table."""
    name = f"days_{uuid.uuid4().hex}"
    columns = [("site_guid", "string", "site"), ("daily_order_cnt", "bigint", "orders"), ("parking_capacity", "bigint", "")]
    sinks.create_day_table(spark, name, columns, "orders by day")
    try:
        _overwritten(_daily(spark, sf_dir), lambda df, day: sinks.overwrite_table_day(df, day, name, order=["site_guid"]))
        read = scratch.staged(readers.read_days(spark, name, DAYS[1], DAYS[2]), "read")
    finally:
        spark.sql(f"DROP TABLE {name}")
    return q._tidy(read)


ORACLE["day_folders"] = ORACLE["day_table"] = _with(
    f"""SELECT site_guid, CAST(CASE WHEN pt = '{DAYS[1]}' THEN -1 ELSE daily_order_cnt END AS BIGINT) AS daily_order_cnt,
        {_big("parking_capacity")}, pt FROM daily WHERE pt BETWEEN '{DAYS[1]}' AND '{DAYS[2]}'""",
    "daily",
)


@query
def csv_json_cells(spark, sf_dir):
    """Packed hourly flows as CSV with JSON cells, read back and decoded."""
    path = scratch.scratch_path(spark, "cells")
    packed = sequences.pack_sequences(td.panel(spark, sf_dir), ["station_id"], "hour", ["inflow", "outflow"])
    sinks.write_csv(packed, path, sep="|", order=["station_id"])
    back = spark.read.option("header", True).option("sep", "|").option("escape", '"').csv(path)
    decoded = back.select("station_id", F.from_json("features", "array<array<double>>").alias("steps"))
    return q._tidy(decoded.select("station_id", F.posexplode("steps").alias("step", "v")).select(
        "station_id", "step", F.col("v")[0].alias("inflow"), F.col("v")[1].alias("outflow"),
    ))


ORACLE["csv_json_cells"] = _with(
    f"""SELECT station_id, date_diff('hour', TIMESTAMP '{td.PANEL_START}', hour) AS step,
        CAST(inflow AS DOUBLE) AS inflow, CAST(outflow AS DOUBLE) AS outflow FROM panel""",
    "panel",
)


@query
def split_sets(spark, sf_dir):
    """Windows split in time order, written by split with the offsets of x and y, and read back."""
    path = scratch.scratch_path(spark, "splits")
    windows = samples.sliding_windows(td.panel(spark, sf_dir), "station_id", "hour", ["outflow"], 6, 3)
    split = samples.ratio_split(windows, 0.6, 0.2).drop("samples")
    sinks.write_splits(split, path, *samples.window_offsets(6, 3))
    total = F.aggregate(F.flatten("x"), F.lit(0.0), lambda a, v: a + v)
    back = spark.read.parquet(path).groupBy("station_id", "split", "x_offsets", "y_offsets").agg(
        F.count("*").alias("rows"), F.min("sample_idx").alias("first"), F.max("sample_idx").alias("last"),
        F.sum(total).alias("x_sum"),
    )
    return q._tidy(back)


_WINDOWS = td.DAYS * 24 - 8
ORACLE["split_sets"] = _with(
    f"""SELECT station_id, split, '[-5,-4,-3,-2,-1,0]' AS x_offsets, '[1,2,3]' AS y_offsets, count(*) AS rows,
        CAST(min(i) AS BIGINT) AS first, CAST(max(i) AS BIGINT) AS last, CAST(sum(x) AS DOUBLE) AS x_sum
      FROM (SELECT *, CASE WHEN i < round_even(0.6 * {_WINDOWS}, 0) THEN 'train'
          WHEN i >= {_WINDOWS} - round_even(0.2 * {_WINDOWS}, 0) THEN 'test' ELSE 'val' END AS split
        FROM (SELECT station_id, date_diff('hour', TIMESTAMP '{td.PANEL_START}', hour) AS i,
            sum(outflow) OVER (PARTITION BY station_id ORDER BY hour ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS x
          FROM panel) WHERE i < {_WINDOWS})
      GROUP BY station_id, split""",
    "panel",
)


@query
def feature_types(spark, sf_dir):
    """Feature typing with as many city slots as there are cities, as JSON lines and back."""
    path = scratch.scratch_path(spark, "types")
    cities = features.city_codes(td.known_cities(spark, sf_dir)).count()
    sinks.write_feature_types(spark, features.feature_types(cities), path)
    rows = [(i, n, *spec) for i, (n, spec) in enumerate(sinks.read_feature_types(spark, path).items())]
    return q._tidy(spark.createDataFrame(rows, sinks.FEATURE_TYPES))


CTES["n_cities"] = (("codes",), "SELECT count(*) AS n FROM codes")
ORACLE["feature_types"] = _with(
    " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS position, '{n}' AS feature, '{kind}' AS kind, "
        f"{repr(coding) if coding else 'NULL'} AS coding, "
        f"CAST({'n + 1' if n == 'city_guid_encoded' else size or 'NULL'} AS BIGINT) AS size FROM n_cities"
        for i, (n, (kind, coding, size)) in enumerate(features.feature_types(0).items())
    ),
    "n_cities",
)


@query
def mapped_orders(spark, sf_dir):
    """A city mapping written as CSV, read as such and joined to the orders in SQL on views."""
    path = scratch.scratch_path(spark, "mapping")
    sinks.write_csv(features.city_codes(td.known_cities(spark, sf_dir)), path)
    mapping, orders = f"cities_{uuid.uuid4().hex}", f"orders_{uuid.uuid4().hex}"
    readers.publish_view(readers.read_mapping(spark, path), mapping)
    readers.publish_view(td.orders(spark, sf_dir).withColumn("city_guid", td.city_of("site_guid")), orders)
    out = spark.sql(
        f"""SELECT c.city_guid_encoded, count(*) AS orders FROM {orders} o
          LEFT JOIN {mapping} c ON c.city_guid = o.city_guid GROUP BY 1"""
    )
    for view in (mapping, orders):
        spark.catalog.dropTempView(view)
    return q._tidy(out)


ORACLE["mapped_orders"] = _with(
    f"""SELECT CAST(c.city_guid_encoded AS BIGINT) AS city_guid_encoded, count(*) AS orders
      FROM departures d LEFT JOIN codes c ON c.city_guid = CAST(CAST(d.station AS INTEGER) % {td.CITIES} AS VARCHAR)
      GROUP BY 1""",
    "departures",
    "codes",
)


@query
def sorted_panel(spark, sf_dir):
    """Panel in files that follow each other: files, rows, and how often a row or a file is out of order."""
    path = scratch.scratch_path(spark, "sorted")
    sinks.write_sorted(td.panel(spark, sf_dir), path, ["station_id", "hour"], rows_per_file=10_000)
    at = F.struct("station_id", "hour").alias("at")
    rows = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"), at, F.col("_metadata.row_index").alias("n"))
    before = F.lag("at").over(W.partitionBy("file").orderBy("n"))
    per_file = rows.withColumn("back", (before > F.col("at")).cast("bigint")).groupBy("file").agg(
        F.count("*").alias("rows"), F.sum("back").alias("back"), F.min("at").alias("low"), F.max("at").alias("high")
    )
    overlap = F.lag("high").over(W.orderBy("low")) >= F.col("low")  # one row per file
    return q._tidy(per_file.withColumn("overlap", overlap.cast("bigint")).agg(
        F.sum("rows").alias("rows"), F.coalesce(F.sum("back"), F.lit(0)).alias("rows_out_of_order"),
        F.coalesce(F.sum("overlap"), F.lit(0)).alias("files_that_overlap"), (F.count("*") > 1).alias("several_files"),
    ))


ORACLE["sorted_panel"] = _with(
    """SELECT count(*) AS rows, CAST(0 AS BIGINT) AS rows_out_of_order, CAST(0 AS BIGINT) AS files_that_overlap,
        true AS several_files FROM panel""",
    "panel",
)


@query
def lag_head(spark, sf_dir):
    """The first rows of one site by a column with nulls, which come last."""
    daily = sites.daily_orders(td.orders(spark, sf_dir).filter("site_guid = '7'"))
    lagged = features.order_day_lag(daily, mode="calendar")
    return q._tidy(profile.preview(lagged, ["lag7d_order_cnt", "pt"], 27))


ORACLE["lag_head"] = _with(
    """SELECT site_guid, pt, daily_order_cnt, CAST(parking_capacity AS BIGINT) AS parking_capacity,
        CAST(lag7d AS BIGINT) AS lag7d_order_cnt
      FROM (SELECT d.*, p.daily_order_cnt AS lag7d FROM daily d
        LEFT JOIN daily p ON p.site_guid = d.site_guid
          AND p.pt = strftime(strptime(d.pt, '%Y%m%d') - INTERVAL 5 DAY, '%Y%m%d')
        WHERE d.site_guid = '7')
      ORDER BY lag7d NULLS LAST, pt LIMIT 27""",
    "daily",
)
