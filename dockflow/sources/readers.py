"""Readers: ride CSV files, day-partitioned tables, snapshots, small mappings, views."""

from __future__ import annotations

import codecs
import csv
import re
import zlib
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockflow.functions.keys import day_text, lenient_timestamp
from dockflow.sources.schemas import CITY_MAPPING

CORRUPT = "_corrupt_record"
SOURCE_FILE = "__source_file"


def _csv(spark: SparkSession, paths, schema: T.StructType, skip_unreadable: bool) -> DataFrame:
    # a file whose header is not the schema's fails by name instead of being read by position
    reader = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnPruning", False)  # else a line with too many fields looks whole
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("mode", "PERMISSIVE" if skip_unreadable else "FAILFAST")
        .option("ignoreCorruptFiles", skip_unreadable)
    )
    return reader.csv(paths).withColumn(SOURCE_FILE, F.col("_metadata.file_name"))


def csv_headers(spark: SparkSession, paths: str | list[str], at_once: int = 16) -> dict[str, list[str]]:
    """Header of every readable file, by path; files without a first line are absent.

    One small job per file, ``at_once`` of them side by side, each a limit of one row that stops its task
    after the first block of the file, so that beginnings are all that is read.
    """
    reader = spark.read.option("ignoreCorruptFiles", True)

    def header(file: str) -> tuple[str, list[str] | None]:
        line = reader.text(file).first()
        return file, next(csv.reader([line["value"]])) if line and line["value"] else None

    files = sorted(reader.text(paths).inputFiles())
    with ThreadPoolExecutor(at_once) as pool:
        return {file: found for file, found in pool.map(header, files) if found}


def unreadable_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Files of ``paths`` that no line could be read from: rows ``(file)``; see :func:`damaged_files`."""
    listed = {_plain(f) for f in spark.read.text(paths).inputFiles()}
    read = {_plain(f) for f in csv_headers(spark, paths)}
    return spark.createDataFrame([(f,) for f in sorted(listed - read)], "file string")


def damaged_files(spark: SparkSession, paths: str | list[str], chunk: int = 1 << 20) -> DataFrame:
    """CSV files of ``paths`` that are not whole: rows ``(file, reason)``.

    Reasons: ``empty``; ``broken gzip`` (data that does not unpack, or ends before its end mark); ``not UTF-8``;
    ``cut off`` (no line end at the end, and the last record has another number of fields than the
    header). Every file is probed where it lies, unpacked piece by piece; a task holds one packed file, of 2 GB at
    most (a larger one fails the probe by name). Whole files without a last line end are not listed.
    """
    found = spark.read.format("binaryFile").load(paths)
    plain = F.regexp_replace("path", "^file:/+", "/").alias("path")
    content = found.select(plain, "content")
    listed = spark.createDataFrame([(_plain(f),) for f in found.inputFiles()], "file string")
    # a scan has no rows for files without bytes
    empty = listed.join(found.select(plain), F.col("file") == F.col("path"), "left_anti").select("file", F.lit("empty").alias("reason"))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path"), batch.column("content")):
                reason = _damage(path.as_py(), memoryview(data.as_buffer()), chunk)
                if reason:
                    yield pa.RecordBatch.from_pydict({"file": [path.as_py()], "reason": [reason]})

    return content.mapInArrow(probe, "file string, reason string").union(empty)


def _pieces(path: str, data: memoryview, chunk: int) -> Iterator[bytes]:
    """Unpacked content; raises ``zlib.error`` where a gzip file breaks or ends early."""
    if not path.endswith((".gz", ".gzip")):
        for at in range(0, len(data), chunk):
            yield bytes(data[at : at + chunk])
        return
    at = 0
    while at < len(data):
        member = zlib.decompressobj(31)
        while not member.eof:
            if at >= len(data):
                raise zlib.error("ends early")
            part = data[at : at + chunk]
            at += len(part)
            yield member.decompress(part)
        at -= len(member.unused_data)


def _damage(path: str, data: memoryview, chunk: int) -> str | None:
    text, header, last, size = codecs.getincrementaldecoder("utf-8")(), None, "", 0
    try:
        for piece in _pieces(path, data, chunk):
            size += len(piece)
            last += text.decode(piece)
            if header is None and "\n" in last:
                header = next(csv.reader([last[: last.index("\n")]]))
            last = last[last.rfind("\n") + 1 :]
        text.decode(b"", final=True)
    except zlib.error:
        return "broken gzip"
    except UnicodeDecodeError:
        return "not UTF-8"
    if not size:
        return "empty"
    fields = next(csv.reader([last])) if last else None
    return "cut off" if fields and header is not None and len(fields) != len(header) else None


def _plain(uri: str) -> str:
    return re.sub("^file:/+", "/", unquote(uri))


def read_csv_files(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str],
    skip_unreadable: bool = True,
    same_header: bool = False,
) -> DataFrame:
    """Stack CSV files as text columns plus the file name and the unparsed record, if any.

    Columns are matched by name: files with equal headers share one scan, the scans are stacked
    and absent columns are null. Headers are read from the beginnings of the files. ``same_header``
    saves that where all files are known to have one header; a file with another one
    then fails the read. Files that cannot be read are skipped (see :func:`unreadable_files`)
    unless ``skip_unreadable`` is off.
    """
    if same_header:
        headers = {tuple(spark.read.option("header", True).csv(paths).columns): paths}
    else:
        headers: dict[tuple[str, ...], list[str]] = {}
        for path, header in csv_headers(spark, paths).items():
            headers.setdefault(tuple(header), []).append(path)
    kinds = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, CORRUPT, SOURCE_FILE)])
    stacked = spark.createDataFrame([], kinds)
    for header, files in headers.items():
        schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
        part = _csv(spark, files, schema, skip_unreadable)
        kept = [c for c in columns if c in header]
        stacked = stacked.unionByName(part.select(*kept, CORRUPT, SOURCE_FILE), allowMissingColumns=True)
    return stacked


def type_rides(raw: DataFrame) -> DataFrame:
    """Times parsed leniently (bad text becomes null), ids as text."""
    times = {c: lenient_timestamp(c) for c in ("started_at", "ended_at") if c in raw.columns}
    ids = {
        c: F.col(c).cast("string")
        for c in ("start_station_id", "end_station_id")
        if c in raw.columns
    }
    return raw.withColumns({**times, **ids})


def unreadable_counts(raw: DataFrame) -> DataFrame:
    """Per file the records, those unparsed, and values of the first column (read with ``read_csv_files``)."""
    first = next(c for c in raw.columns if c not in (CORRUPT, SOURCE_FILE))
    # the parser needs a data column besides the corrupt record, hence the third count
    return raw.groupBy(SOURCE_FILE).agg(
        F.count("*").alias("records"), F.count(CORRUPT).alias("unreadable"), F.count(first).alias(f"{first}_values")
    )


#: Formats whose files take a schema from the reader; others (catalog formats) bring their own.
FILE_FORMATS = ("parquet", "orc", "json", "csv")


def read_days(
    spark: SparkSession,
    source: str,
    first: date | str,
    last: date | str,
    fmt: str | None = None,
    day_column: str = "pt",
    schema: T.StructType | None = None,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Days ``first``..``last`` (inclusive, dates or day keys) of a catalog table or a path.

    ``fmt`` names the format of a path, e.g. ``parquet`` or ``iceberg``; without it
    ``source`` is a table. The filter compares the raw string partition column with string
    literals, so it prunes partitions. ``names`` renames columns of the source. With ``schema`` the result has
    its columns and types; a column that the source lacks raises.
    """
    names = dict(names or {})
    if fmt is None:
        table = spark.table(source)
    elif fmt in FILE_FORMATS:
        reader = spark.read.format(fmt)
        found = reader.load(source).schema
        # keep yyyyMMdd partition values as text
        kept = [T.StructField(f.name, T.StringType() if f.name == day_column else f.dataType) for f in found.fields]
        table = reader.schema(T.StructType(kept)).load(source)
    else:
        table = spark.read.format(fmt).load(source)
    table = between_days(table, first, last, day_column).withColumnsRenamed(names)
    if schema is None:
        return table
    absent = [f.name for f in schema.fields if f.name not in table.columns]
    if absent:
        raise ValueError(f"{source} has no column {', '.join(absent)}; it has {', '.join(table.columns)}")
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def between_days(df: DataFrame, first: date | str, last: date | str, day_column: str = "pt") -> DataFrame:
    return df.filter(F.col(day_column).between(day_text(first), day_text(last)))


def on_the_hour(snapshots: DataFrame, minute: str = "00") -> DataFrame:
    """Snapshots taken at ``minute``, keyed by hour key ``dt``."""
    return snapshots.filter(F.col("min") == minute).withColumn("dt", F.concat("pt", "hr"))


def read_mapping(spark: SparkSession, path: str, schema: T.StructType = CITY_MAPPING) -> DataFrame:
    """Small mapping CSV with a header row."""
    return spark.read.schema(schema).option("header", True).csv(path)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Register for SQL and hand the frame on."""
    df.createOrReplaceTempView(name)
    return df


def numeric_if_possible(c: Column | str) -> Column:
    """Numeric reading of an id column, null where it is not a number."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("bigint")
