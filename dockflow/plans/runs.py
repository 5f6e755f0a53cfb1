"""Whole runs: daily features, scoring and publishing, training export, open ride files.

A run reads its sources, writes its sinks and returns the frames it wrote, read back from
where they were written, so that a later step never recomputes an earlier one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.functions import keys as K
from dockflow.operators import (
    features,
    flow,
    forecast,
    numbering,
    publish,
    samples,
    sequences,
    sites,
)
from dockflow.sources import readers, schemas, sinks

SCHEMAS = {
    "orders": schemas.ORDERS,
    "labels": schemas.HOURLY_LABELS,
    "snapshots": schemas.VEHICLE_SNAPSHOTS,
    "weather": schemas.WEATHER_WORKDAY,
    "fences": schemas.FENCE_DIM,
}
SINKS = {
    "predict_features": schemas.PREDICT_FEATURES,
    "train_features": schemas.TRAIN_FEATURES,
    "hourly_predictions": schemas.HOURLY_PREDICTIONS,
    "json_predictions": schemas.JSON_PREDICTIONS,
}


@dataclass(frozen=True)
class Places:
    """Where the day-partitioned sources are and where results go.

    ``sources`` maps ``orders, labels, snapshots, weather, fences`` to a path in ``fmt``, or to a
    catalog table if ``fmt`` is None. Results then go to declared tables of the database ``out``,
    else to folders below ``out``. ``names`` renames columns of a source.
    """

    sources: Mapping[str, str]
    out: str
    fmt: str | None = "parquet"
    names: Mapping[str, Mapping[str, str]] = field(default_factory=lambda: {"orders": schemas.ORDER_NAMES})

    def days(self, spark: SparkSession, name: str, first: date, last: date, day: str = "pt") -> DataFrame:
        renamed = self.names.get(name)
        return readers.read_days(spark, self.sources[name], first, last, self.fmt, day, SCHEMAS[name], renamed)

    def sink(self, name: str) -> str:
        return f"{self.out}.{name}" if self.fmt is None else f"{self.out}/{name}"

    def put(self, df: DataFrame, name: str, day: date | str, order: Sequence[str] = ()) -> DataFrame:
        """Write one day of a result and read it from there."""
        spark, target = df.sparkSession, self.sink(name)
        if name in SINKS:
            df = sinks.checked(df, SINKS[name])
        if self.fmt is None:
            columns = [(f.name, f.dataType.simpleString(), "") for f in df.schema.fields if f.name != "pt"]
            sinks.create_day_table(spark, target, columns)
            sinks.overwrite_table_day(df, day, target, order=order)
        else:
            sinks.overwrite_day(df, day, target, order=order)
        return self.got(spark, name, day)

    def got(self, spark: SparkSession, name: str, day: date | str) -> DataFrame:
        """One written day, without listing the others."""
        if self.fmt is None:
            return readers.between_days(spark.table(self.sink(name)), day, day).drop("pt")
        return spark.read.parquet(f"{self.sink(name)}/pt={K.day_text(day)}")


@dataclass(frozen=True)
class Thresholds:
    """Site eligibility: 5 orders on the best day to predict, 15 or a mean of 10 to train."""

    predict_max: float = 5
    train_max: float = 15
    train_mean: float = 10


# ---- prediction features -----------------------------------------------------------------


def write_predict_features(
    spark: SparkSession,
    places: Places,
    today: str,
    weeks: int = 2,
    steps: int | None = None,
    limits: Thresholds = Thresholds(),
    spec: features.HourlySpec = features.PREDICT_HOURLY,
) -> DataFrame:
    """Hourly features of eligible sites as JSON sequences, in tomorrow's partition."""
    dates = K.RunDates.predict(today, weeks)
    daily = sites.daily_orders(places.days(spark, "orders", dates.activity_start, dates.end))
    active = sites.eligible_sites(sites.site_activity(daily), limits.predict_max)
    hourly = features.hourly_features(
        places.days(spark, "labels", dates.warm_up_start, dates.end),
        active,
        places.days(spark, "snapshots", dates.start, dates.end),
        places.days(
            spark, "weather", *dates.weather_days, "forecast_date"
        ),
        dates,
        spec,
    )
    packed = sequences.pack_sequences(
        hourly, ["site_guid"], "dt", spec.columns, steps or weeks * 7 * 24
    )
    text = packed.withColumn("features", F.to_json("features"))
    return places.put(text, "predict_features", dates.tomorrow, ["site_guid"])


# ---- scoring and publishing --------------------------------------------------------------


def score_and_publish(
    spark: SparkSession,
    places: Places,
    today: str,
    make_scorer: Callable[[], forecast.Scorer],
    steps: int = 336,
    width: int = len(features.PREDICT_COLUMNS),
) -> dict[str, DataFrame]:
    """Decode tomorrow's features, score them, publish hourly rows and JSON; keep the rejects."""
    dates = K.RunDates.predict(today)
    day = dates.tomorrow
    encoded = places.got(spark, "predict_features", day)
    decoded = sequences.decode_sequences(encoded, "features", steps, width)
    bad = places.put(sequences.rejected(decoded), "rejected_features", day)
    scored = forecast.score_sites(sequences.accepted(decoded), make_scorer, steps, width)
    counts = publish.whole_counts(scored.withColumnRenamed("site_guid", "id"))
    # the scorer runs once; both published forms read its written result
    counts = places.put(counts, "forecasts", day)
    fences = publish.current_fences(
        places.days(spark, "fences", dates.yesterday, dates.yesterday), dates.yesterday
    )
    hourly = places.put(publish.hourly_rows(counts, fences), "hourly_predictions", day, ["parking_guid", "hour"])
    return {
        "rejected_features": bad,
        "forecasts": counts,
        "hourly_predictions": hourly,
        "json_predictions": places.put(publish.json_rows(counts), "json_predictions", day),
    }


# ---- training export -----------------------------------------------------------------------


def write_training_features(
    spark: SparkSession,
    places: Places,
    today: str,
    day: str,
    weeks: int = 6,
    steps: int | None = None,
    daily_steps: int | None = None,
    limits: Thresholds = Thresholds(),
    spec: features.HourlySpec = features.TRAIN_HOURLY,
) -> DataFrame:
    """Hourly and daily sequences per site, in the partition ``day``."""
    dates = K.RunDates.train(today, weeks)
    daily = sites.daily_orders(places.days(spark, "orders", dates.activity_start, dates.end))
    active = sites.eligible_sites(
        sites.site_activity(daily), limits.train_max, limits.train_mean
    ).dropna(subset=["site_guid"])
    hourly = features.hourly_features(
        places.days(spark, "labels", dates.warm_up_start, dates.end),
        active,
        places.days(spark, "snapshots", dates.start, dates.end),
        None,
        dates,
        spec,
    )
    packed = sequences.pack_sequences(
        hourly, ["site_guid", "city_guid"], "dt", spec.columns, steps or weeks * 7 * 24, "hourly_features"
    ).withColumn("hourly_features", F.to_json("hourly_features"))
    packed = places.put(packed, "train_hourly", day)

    first, last = dates.label_start, dates.label_end
    fences = places.days(spark, "fences", *dates.fence_days)
    codes = features.city_codes(publish.city_fences(fences, *dates.fence_days))
    codes = places.put(codes, "city_codes", day)
    static = features.static_features(
        packed.select("site_guid", "city_guid"),
        places.days(spark, "orders", K.days_after(first, -10), last),
        codes,
        places.days(
            spark,
            "weather",
            *dates.label_weather_days,
            "pred_date",
        ),
        dates,
    )
    daily_packed = sequences.pack_sequences(
        static,
        ["site_guid"],
        "pt",
        features.DAILY_COLUMNS,
        daily_steps or weeks * 7 - 16,
        "static_features",
    ).withColumn("static_features", F.to_json("static_features"))
    joined = sequences.join_sequences(packed, daily_packed)
    return places.put(joined, "train_features", day, ["site_guid"])


def export_batches(
    spark: SparkSession,
    places: Places,
    day: str,
    batch_size: int = 2500,
    hourly_shape: tuple[int, int] = (1008, len(features.TRAIN_COLUMNS)),
    static_shape: tuple[int, int] = (26, len(features.DAILY_COLUMNS)),
    folder: str | None = None,
) -> dict[str, DataFrame]:
    """Validated matrices in pages of sites, and how hourly and daily ones line up per page.

    Batches are files: below ``folder``, or below ``places.out`` where that is a path.
    """
    if places.fmt is None and folder is None:
        raise ValueError("name a folder for the batches")
    encoded = places.got(spark, "train_features", day)
    keys = numbering.row_numbers(encoded.select("site_guid"), ["site_guid"])
    paged = encoded.join(numbering.pages(keys, batch_size), "site_guid")

    def good(column: str, shape: tuple[int, int]) -> DataFrame:
        keyed = paged.select("site_guid", "batch_id", column)
        decoded = sequences.decode_sequences(keyed, column, *shape, name="steps")
        return sequences.as_float32(sequences.accepted(decoded)).select(
            "site_guid", "batch_id", F.col("steps").alias(column)
        )

    out = {}
    for name, column, shape in (
        ("batches_hourly", "hourly_features", hourly_shape),
        ("batches_static", "static_features", static_shape),
    ):
        path = f"{folder or places.out}/{name}"
        sinks.write_batches(good(column, shape), path)
        out[name] = sinks.read_batches(spark, path)
    out["alignment"] = sequences.alignment(
        out["batches_hourly"], out["batches_static"], "site_guid", ["batch_id"], ("hourly", "static")
    )
    return out


def merge_batches(hourly: DataFrame, static: DataFrame) -> DataFrame:
    """Sites with both matrices, one row each."""
    return hourly.drop("batch_id").join(static.drop("batch_id"), "site_guid")


# ---- open ride files -----------------------------------------------------------------------


@dataclass(frozen=True)
class OpenRange:
    """Panel range and cut-offs of an open ride data set."""

    start: str = "2025-04-01 00:00:00"
    end: str = "2025-08-31 23:00:00"
    cutoff: str = "2025-08-30 23:00:00"
    busy_from: str = "2025-04-01 00:00:00"
    busy_before: str = "2025-07-01 00:00:00"
    busy_mean: float = 10
    lag_cutoff: str = "2025-04-15 00:00:00"
    splits: Mapping[str, tuple[int, int]] = field(default_factory=lambda: samples.OPEN_SPLITS)


def prepare_open_rides(
    spark: SparkSession,
    paths: str | list[str],
    out: str,
    span: OpenRange = OpenRange(),
    same_header: bool = False,
    keep_unknown: bool = False,
) -> dict[str, DataFrame]:
    """Ride CSVs to the dense panel, its lag features and one packed sequence per station."""
    raw = readers.read_csv_files(
        spark,
        paths,
        ["started_at", "ended_at", "start_station_id", "end_station_id"],
        same_header=same_header,
    )
    # text is parsed once; the flow and the station filter read columns
    readers.type_rides(raw).write.mode("overwrite").parquet(f"{out}/rides")
    rides = spark.read.parquet(f"{out}/rides")
    hourly = flow.hourly_flow(rides, keep_unknown)
    panel = flow.dense_panel(hourly, span.start, span.end)
    flow.future_flow(panel, cutoff=span.cutoff).sortWithinPartitions("station_id", "hour").write.mode("overwrite").parquet(f"{out}/panel")
    future = spark.read.parquet(f"{out}/panel")
    sinks.write_csv(future, f"{out}/panel_csv", order=["station_id", "hour"])

    busy = sites.busy_stations(rides, span.busy_from, span.busy_before, span.busy_mean)
    lagged = features.panel_lags(sites.keep_sites(future, busy, "station_id", "station_id"))
    lagged.sortWithinPartitions("station_id", "hour").write.mode("overwrite").parquet(f"{out}/lagged")
    lagged = spark.read.parquet(f"{out}/lagged")

    kept = flow.time_range(lagged, "hour", start=span.lag_cutoff)
    packed = sequences.pack_sequences(kept, ["station_id"], "hour", features.PANEL_COLUMNS)
    packed.write.mode("overwrite").parquet(f"{out}/sequences")
    packed = spark.read.parquet(f"{out}/sequences")
    sinks.write_csv(packed, f"{out}/sequences_csv", sep="|")
    return {"panel": future, "lagged": lagged, "sequences": packed}


def write_graph_splits(
    lagged: DataFrame,
    path: str,
    past: int = 72,
    future: int = 24,
    y_start: int = 1,
    train: float = 0.6,
    test: float = 0.2,
) -> DataFrame:
    """Stride-1 windows of all stations, split in time order, with their step offsets."""
    windows = samples.sliding_windows(
        lagged, "station_id", "hour", features.PANEL_COLUMNS, past, future, y_start
    )
    split = samples.ratio_split(windows, train, test).drop("samples")
    sinks.write_splits(split, path, *samples.window_offsets(past, future, y_start))
    return lagged.sparkSession.read.parquet(path)


def daily_training_sets(
    packed: DataFrame,
    seq_days: int = 7,
    splits: Mapping[str, tuple[int, int]] = samples.OPEN_SPLITS,
    share: float = 0.4,
    seed: int = 12345,
) -> DataFrame:
    """Daily samples of every split; of the training samples only a random share."""
    parts = samples.split_days(packed, splits)
    rows = samples.daily_samples(parts, seq_days, {"y": 0})
    # the share is drawn from the keys alone; the samples are cut once
    counts = samples.packed_counts(parts.filter(F.col("split") == "train"), "station_id", seq_days)
    picked = numbering.fraction_exact(
        samples.sample_keys(counts), ["station_id", "sample_idx"], share, seed
    ).withColumn("split", F.lit("train"))
    others = F.col("split") != "train"
    marked = rows.join(picked.withColumn("_picked", F.lit(True)), ["station_id", "sample_idx", "split"], "left")
    return marked.filter(others | F.col("_picked")).drop("_picked").select(rows.columns)
