"""Readers and sinks: written, read back and compared."""

import gzip
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dockflow.operators import features
from dockflow.sources import readers, schemas, sinks


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


COLUMNS = ["started_at", "ended_at", "start_station_id", "end_station_id"]


def test_csv_files_are_stacked_tagged_and_typed(spark, tmp_path):
    head = "ride_id,started_at,ended_at,start_station_id,end_station_id\n"
    _write(tmp_path / "2024-rides-1.csv", head + "r1,2024-01-01 10:00:00,bad,007,9\n")
    _write(tmp_path / "2024-rides-2.csv", head + "r2,2024-01-02 10:00:00,2024-01-02 11:00:00,,9\n")
    _write(tmp_path / "other.csv", "x\n1\n")
    raw = readers.read_csv_files(spark, f"{tmp_path}/*rides*.csv", COLUMNS)
    rides = readers.type_rides(raw)
    out = {r["__source_file"]: r for r in rides.collect()}
    assert set(out) == {"2024-rides-1.csv", "2024-rides-2.csv"}
    first = out["2024-rides-1.csv"]
    assert (first.started_at, first.ended_at) == (datetime(2024, 1, 1, 10), None)
    assert first.start_station_id == "007"
    assert out["2024-rides-2.csv"].start_station_id is None


def test_csv_files_with_other_columns_are_stacked_by_name(spark, tmp_path):
    _write(tmp_path / "a.csv", "started_at,start_station_id\n2024-01-01 00:00:00,a\n")
    _write(tmp_path / "b.csv", "start_station_id,end_station_id,started_at\nb,c,2024-01-02 00:00:00\n")
    raw = readers.read_csv_files(
        spark, [str(tmp_path / n) for n in ("a.csv", "b.csv")], COLUMNS
    )
    out = {r.start_station_id: r for r in readers.type_rides(raw).collect()}
    assert out["a"].end_station_id is None and out["b"].end_station_id == "c"
    assert out["b"].started_at == datetime(2024, 1, 2)


def test_unreadable_files_are_skipped(spark, tmp_path):
    with gzip.open(tmp_path / "good.csv.gz", "wt") as f:
        f.write("a,b\n1,2\n3,4\n")
    broken = (tmp_path / "good.csv.gz").read_bytes()[:15] + os.urandom(30)
    (tmp_path / "zbroken.csv.gz").write_bytes(broken)
    raw = readers.read_csv_files(spark, [str(tmp_path / "good.csv.gz"), str(tmp_path / "zbroken.csv.gz")], ["a", "b"])
    assert _rows(raw.filter(F.col("__source_file") == "good.csv.gz").select("a", "b")) == [("1", "2"), ("3", "4")]
    lost = readers.unreadable_files(spark, f"{tmp_path}/*.csv.gz")
    assert [r.file.rpartition("/")[2] for r in lost.collect()] == ["zbroken.csv.gz"]


def test_columns_in_another_order_keep_their_values(spark, tmp_path):
    _write(tmp_path / "a.csv", "started_at,start_station_id\n2024-01-01 00:00:00,a\n")
    _write(tmp_path / "b.csv", "start_station_id,started_at\nb,2024-01-02 00:00:00\n")
    out = readers.type_rides(readers.read_csv_files(spark, f"{tmp_path}/*.csv", COLUMNS))
    assert _rows(out.select("start_station_id", F.col("started_at").cast("date").cast("string"))) == [
        ("a", "2024-01-01"), ("b", "2024-01-02"),
    ]
    with pytest.raises(Exception):
        readers.read_csv_files(spark, f"{tmp_path}/*.csv", COLUMNS, skip_unreadable=False, same_header=True).collect()


def test_no_readable_file_gives_no_rows(spark, tmp_path):
    _write(tmp_path / "empty.csv", "")
    assert readers.read_csv_files(spark, f"{tmp_path}/*.csv", ["a"]).count() == 0


def test_absent_columns_raise_and_names_are_mapped(spark, frame, tmp_path):
    path = str(tmp_path / "orders")
    rows = frame([("o", "s", 3)], "order_id string, bike_start_park_guid string, start_parking_capacity long")
    sinks.overwrite_day(rows, "20240101", path)
    with pytest.raises(ValueError, match="site_guid"):
        readers.read_days(spark, path, "20240101", "20240101", "parquet", schema=schemas.ORDERS)
    df = readers.read_days(
        spark, path, "20240101", "20240101", "parquet", schema=schemas.ORDERS, names=schemas.ORDER_NAMES
    )
    assert _rows(df) == [("o", "s", 3, "20240101")]
    with pytest.raises(ValueError, match="features"):
        sinks.checked(rows, schemas.PREDICT_FEATURES)


def test_files_are_sorted(spark, tmp_path):
    df = spark.range(1000).select(F.pmod(F.col("id") * 7919, F.lit(1000)).alias("k")).repartition(3)
    sinks.overwrite_day(df, "20240101", str(tmp_path / "t"), order=["k"])
    for name in os.listdir(tmp_path / "t" / "pt=20240101"):
        if name.endswith(".parquet"):
            keys = [r.k for r in spark.read.parquet(str(tmp_path / "t" / "pt=20240101" / name)).collect()]
            assert keys == sorted(keys)


def test_corrupt_lines_are_counted(spark, tmp_path):
    _write(tmp_path / "x.csv", "a,b\n1,2\n1,2,3,4\n")
    raw = readers.read_csv_files(spark, str(tmp_path / "x.csv"), ["a", "b"])
    assert _rows(readers.unreadable_counts(raw)) == [("x.csv", 2, 1, 2)]
    with pytest.raises(Exception):
        readers.read_csv_files(spark, str(tmp_path / "x.csv"), ["a", "b"], skip_unreadable=False).collect()


def test_day_partitions_are_pruned_and_overwritten_alone(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    for day in ("20240101", "20240102", "20240103"):
        sinks.overwrite_day(frame([(day, 1)], "k string, v long"), day, path)
    sinks.overwrite_day(frame([("new", 2)], "k string, v long"), "20240102", path)
    sinks.overwrite_day(frame([("new", 2)], "k string, v long"), "20240102", path)
    df = readers.read_days(spark, path, "20240102", "20240103", "parquet")
    assert _rows(df.select("k", "v", "pt")) == [("20240103", 1, "20240103"), ("new", 2, "20240102")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pt" in plan
    assert "cast(pt" not in plan
    assert readers.read_days(spark, path, "20240101", "20240101", "parquet").count() == 1


def test_declared_table_is_filled_by_name(spark, frame):
    spark.sql("DROP TABLE IF EXISTS features_t")
    columns = [("site_guid", "string", "the site's id"), ("features", "string", "vectors")]
    sinks.create_day_table(spark, "features_t", columns, "hourly features")
    swapped = frame([("[[1.0]]", "s")], "features string, site_guid string")
    sinks.overwrite_table_day(swapped, "20240101", "features_t")
    sinks.overwrite_table_day(swapped, "20240102", "features_t")
    sinks.overwrite_table_day(swapped.withColumn("features", F.lit("[]")), "20240101", "features_t")
    out = readers.read_days(spark, "features_t", "20240101", "20240101")
    assert _rows(out) == [("s", "[]", "20240101")]
    assert spark.table("features_t").count() == 2
    described = {r.col_name: r.comment for r in spark.sql("DESCRIBE features_t").collect()}
    assert described["site_guid"] == "the site's id"
    spark.sql("DROP TABLE features_t")


def test_csv_with_json_cells(spark, frame, tmp_path):
    df = frame([("a", [[1.0, 2.5]])], "id string, features array<array<double>>")
    sinks.write_csv(df, str(tmp_path / "c"), sep="|")
    back = spark.read.option("header", True).option("sep", "|").csv(str(tmp_path / "c"))
    assert tuple(back.first()) == ("a", "[[1.0,2.5]]")


def test_batches_and_splits(spark, tmp_path):
    df = spark.range(100).withColumn("batch_id", F.floor(F.col("id") / 30))
    sinks.write_batches(df, str(tmp_path / "b"))
    assert sorted(p for p in os.listdir(tmp_path / "b") if p.startswith("batch")) == [
        f"batch_id={i}" for i in range(4)
    ]
    assert sinks.read_batches(spark, str(tmp_path / "b")).count() == 100
    parts = df.withColumn("split", F.when(F.col("id") < 60, "train").otherwise("test"))
    sinks.write_splits(parts, str(tmp_path / "s"), [-1, 0], [1])
    back = spark.read.parquet(str(tmp_path / "s"))
    row = back.filter("split = 'test'").first()
    assert (row.x_offsets, row.y_offsets) == ([-1, 0], [1])
    assert back.filter("split = 'train'").count() == 60


def test_feature_types_round_trip(spark, tmp_path):
    types = features.feature_types(7)
    sinks.write_feature_types(spark, types, str(tmp_path / "types"))
    assert sinks.read_feature_types(spark, str(tmp_path / "types")) == types


def test_snapshots_views_mapping_and_reuse(spark, frame, tmp_path):
    shots = frame([("p", "00", "07", "20240101"), ("p", "30", "07", "20240101")], "parking_guid string, min string, hr string, pt string")
    assert [r.dt for r in readers.on_the_hour(shots).collect()] == ["2024010107"]
    readers.publish_view(shots, "shots")
    assert spark.sql("SELECT count(*) FROM shots").first()[0] == 2
    _write(tmp_path / "m.csv", "city_guid,city_guid_encoded\n0a,0\n")
    assert tuple(readers.read_mapping(spark, str(tmp_path / "m.csv")).first()) == ("0a", 0)
    with sinks.reused(shots) as kept:
        assert kept.is_cached and kept.count() == 2
    assert not shots.is_cached
    ids = frame([("12",), ("x1",)], "s string").select(readers.numeric_if_possible("s"))
    assert _rows(ids) == [(12,), (None,)]


def test_checkpoint_folder_comes_from_the_session(spark):
    from dockflow.session import ensure_checkpoint_dir

    assert spark.conf.get("spark.checkpoint.dir") in ensure_checkpoint_dir(spark)


def _bytes_read(log_dir) -> int:
    import json

    total = 0
    for name in os.listdir(log_dir):
        with open(log_dir / name) as lines:
            for line in lines:
                event = json.loads(line)
                if event["Event"] == "SparkListenerTaskEnd":
                    total += (event.get("Task Metrics") or {}).get("Input Metrics", {}).get("Bytes Read", 0)
    return total


def test_headers_read_the_beginning_of_files_only(spark, tmp_path):
    """Bytes read by the scan's tasks, from the event log of a session of its own."""
    import subprocess
    import sys

    line = "x" * 98 + ",1\n"
    for i in range(3):
        _write(tmp_path / f"big{i}.csv", f"a{i},b\n" + line * 200_000)  # 20 MB each
    (tmp_path / "log").mkdir()
    code = f"""
from dockflow.session import build_session
from dockflow.sources import readers
spark = build_session("headers", "local[2]", {{"spark.ui.enabled": "false", "spark.eventLog.enabled": "true",
    "spark.eventLog.dir": "file://{tmp_path}/log", "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"}})
found = readers.csv_headers(spark, "{tmp_path}/*.csv")
assert sorted(found.values()) == [["a0", "b"], ["a1", "b"], ["a2", "b"]], found
spark.stop()
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(__file__)), capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    assert _bytes_read(tmp_path / "log") < 5_000_000


def test_damaged_files_are_listed_with_their_reason(spark, tmp_path):
    good = "a,b\n" + "".join(f"{i},ü{i}\n" for i in range(20_000))
    _write(tmp_path / "good.csv", good)
    _write(tmp_path / "noend.csv", good.rstrip("\n"))
    _write(tmp_path / "cut.csv", good[: good.rindex(",")])
    _write(tmp_path / "empty.csv", "")
    (tmp_path / "latin.csv").write_bytes("a,b\n1,é\n".encode("latin-1"))
    packed = gzip.compress(good.encode())
    (tmp_path / "good.csv.gz").write_bytes(packed + gzip.compress(b"7,8\n"))
    (tmp_path / "tail.csv.gz").write_bytes(packed[:-9])
    (tmp_path / "noise.csv.gz").write_bytes(packed[:500] + bytes(300) + packed[800:])
    got = {r.file.rpartition("/")[2]: r.reason for r in readers.damaged_files(spark, f"{tmp_path}/*.csv*", 4096).collect()}
    assert got == {
        "cut.csv": "cut off", "empty.csv": "empty", "latin.csv": "not UTF-8", "tail.csv.gz": "broken gzip",
        "noise.csv.gz": "broken gzip",
    }


def _failing(spark):
    def fail(frames):
        for frame in frames:
            yield frame
        raise ValueError("half-way")

    return spark.range(100, numPartitions=1).mapInPandas(fail, "id long").withColumnRenamed("id", "v")


def test_a_failed_overwrite_keeps_the_old_day(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    old = frame([(1,), (2,)], "v long")
    sinks.overwrite_day(old, "20240101", path)
    with pytest.raises(Exception, match="half-way"):
        sinks.overwrite_day(_failing(spark), "20240101", path)
    assert _rows(spark.read.parquet(path).select("v")) == [(1,), (2,)]
    # a stop between the two renames
    os.makedirs(tmp_path / "t" / "_staging" / "pt=20240101")
    os.rename(tmp_path / "t" / "pt=20240101", tmp_path / "t" / "_staging" / "pt=20240101" / "old")
    with pytest.raises(Exception, match="half-way"):
        sinks.overwrite_day(_failing(spark), "20240101", path)
    assert _rows(spark.read.parquet(path).select("v")) == [(1,), (2,)]
    sinks.overwrite_day(old.limit(0), "20240101", path)
    assert spark.read.schema("v long").parquet(path).count() == 0
    assert os.listdir(tmp_path / "t" / "_staging") == []


def test_a_failed_overwrite_keeps_the_old_day_of_a_table(spark, frame):
    spark.sql("DROP TABLE IF EXISTS days_t")
    sinks.create_day_table(spark, "days_t", [("v", "bigint", "value")])
    sinks.overwrite_table_day(frame([(1,), (2,)], "v int"), "20240101", "days_t")
    sinks.overwrite_table_day(frame([(9,)], "v int"), "20240102", "days_t")
    with pytest.raises(Exception, match="half-way"):
        sinks.overwrite_table_day(_failing(spark), "20240101", "days_t")
    assert _rows(spark.table("days_t")) == [(1, "20240101"), (2, "20240101"), (9, "20240102")]
    running = spark.table("days_t").filter("pt = '20240101'")
    plan = running._jdf.queryExecution().executedPlan()  # a reader that has listed its files
    assert plan is not None
    sinks.overwrite_table_day(frame([(3,)], "v int"), "20240101", "days_t")
    assert _rows(running) == [(1, "20240101"), (2, "20240101")]
    for value in (4, 5):
        sinks.overwrite_table_day(frame([(value,)], "v int"), "20240101", "days_t")
    assert _rows(spark.table("days_t").filter("pt = '20240101'")) == [(5, "20240101")]
    sinks.overwrite_table_day(frame([(5,)], "v int").limit(0), "20240101", "days_t")
    assert _rows(spark.table("days_t")) == [(9, "20240102")]
    spark.sql("DROP TABLE days_t")


def test_sorted_files_do_not_overlap(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.range(20_000).select(
        F.concat(F.lit("s"), F.lpad((F.col("id") * 7919 % 50).cast("string"), 2, "0")).alias("site"), F.col("id").alias("hour")
    )
    sinks.write_sorted(df.repartition(7), str(tmp_path / "s"), ["site", "hour"], rows_per_file=2000)
    ranges = []
    for name in os.listdir(tmp_path / "s"):
        if name.endswith(".parquet"):
            meta = pq.ParquetFile(tmp_path / "s" / name).metadata
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(0).statistics
                ranges.append((stats.min, stats.max))
    assert len(ranges) >= 8
    assert sum(lo <= "s17" <= hi for lo, hi in ranges) <= 2  # row groups left for one station
    assert spark.read.parquet(str(tmp_path / "s")).exceptAll(df).count() == 0
