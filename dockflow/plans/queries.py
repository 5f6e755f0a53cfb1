"""Registered queries: every operator over the whole supplied tables.

Each takes (spark, sf_dir). Integers are returned as bigint, measures as double, calendar days
as text and nested arrays as JSON text, so that results compare the same in any engine.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockflow.functions import keys as K
from dockflow.functions import vectors as V
from dockflow.operators import (
    features,
    flow,
    forecast,
    graph,
    metrics,
    numbering,
    profile,
    publish,
    samples,
    sequences,
    sites,
)
from dockflow.sources import adapters as td
from dockflow.sources import readers, scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# run parameters on the 30 days of the test tables
PREDICT = K.RunDates.predict("20240201", weeks=2)
TRAIN = K.RunDates.train("20240130", weeks=4)
MAX_ORDERS = 8
MEAN_ORDERS = 3.6
BUSY_RANGE = ("2024-01-01 00:00:00", "2024-01-21 00:00:00")
PANEL_CUTOFF = "2024-01-29 23:00:00"
LAG_CUTOFF = "2024-01-14 00:00:00"
PREDICT_STEPS = 40
TRAIN_STEPS = 80
DAILY_STEPS = 12
PAST, FUTURE = 72, 24
BATCH = 64
TRAIN_SAMPLES = 14
OUTFLOW = td.FLOW_FEATURES.index("outflow")
DAY_SPLITS = {"train": (0, 18), "val": (18, 24), "test": (24, 30)}
OVERLAP_SPLITS = {"train": (0, 23), "val": (5, 26), "test": (9, 30)}
OVERLAP_STATIC = {"train": (0, 6), "val": (6, 10), "test": (10, 14)}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Plain column types: bigint, rounded double, text."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.ArrayType, T.StructType)):
            c = F.to_json(c)
        columns.append(c.alias(f.name))
    return df.select(columns)


def _doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# ---- hourly flow and panel ---------------------------------------------------------------


@query
def hourly_outflow(spark, sf_dir):
    return _tidy(flow.hourly_outflow(td.ride_starts(spark, sf_dir)))


@query
def hourly_inflow(spark, sf_dir):
    return _tidy(flow.hourly_inflow(td.rides(spark, sf_dir)))


@query
def hourly_flow(spark, sf_dir):
    return _tidy(flow.hourly_flow(td.rides(spark, sf_dir)))


@query
def dense_panel(spark, sf_dir):
    return _tidy(td.panel(spark, sf_dir))


def _future(spark, sf_dir):
    return flow.future_flow(td.panel(spark, sf_dir), cutoff=PANEL_CUTOFF)


@query
def future_12h_flow(spark, sf_dir):
    return _tidy(_future(spark, sf_dir))


# ---- sites and lags --------------------------------------------------------------------


def _activity(spark, sf_dir):
    orders = td.between_days(td.orders(spark, sf_dir), PREDICT.activity_start, PREDICT.end)
    return sites.site_activity(sites.daily_orders(orders))


def _train_sites(spark, sf_dir):
    return sites.eligible_sites(_activity(spark, sf_dir), MAX_ORDERS, MEAN_ORDERS)


def _predict_sites(spark, sf_dir):
    return sites.eligible_sites(_activity(spark, sf_dir), MAX_ORDERS)


@query
def active_sites(spark, sf_dir):
    return _tidy(_train_sites(spark, sf_dir))


@query
def site_union(spark, sf_dir):
    activity = _activity(spark, sf_dir)
    by_max = sites.eligible_sites(activity, max_at_least=MAX_ORDERS)
    by_mean = sites.eligible_sites(activity, mean_at_least=MEAN_ORDERS)
    return sites.either_set(by_max.select("site_guid"), by_mean.select("site_guid"))


def _busy_flow(spark, sf_dir):
    busy = sites.busy_stations(td.ride_starts(spark, sf_dir), *BUSY_RANGE, MEAN_ORDERS)
    return sites.keep_sites(_future(spark, sf_dir), busy, "station_id", "station_id")


@query
def active_site_flow(spark, sf_dir):
    return _tidy(_busy_flow(spark, sf_dir))


def _lagged_panel(spark, sf_dir):
    lagged = features.panel_lags(_busy_flow(spark, sf_dir))
    return flow.time_range(lagged, "hour", start=LAG_CUTOFF)


@query
def panel_lags(spark, sf_dir):
    out = _lagged_panel(spark, sf_dir).select("station_id", "hour", *features.PANEL_COLUMNS)
    return _tidy(_doubles(out, features.PANEL_COLUMNS))


@query
def panel_sequences(spark, sf_dir):
    lagged = _lagged_panel(spark, sf_dir)
    return _tidy(
        sequences.pack_sequences(lagged, ["station_id"], "hour", features.PANEL_COLUMNS)
    )


def _lags(spark, sf_dir, mode):
    lagged = features.same_hour_lags(td.hourly_labels(spark, sf_dir), mode=mode)
    kept = features.fill_numeric(td.between_days(lagged, PREDICT.start, PREDICT.end))
    return _tidy(kept)


@query
def same_hour_lags(spark, sf_dir):
    return _lags(spark, sf_dir, "rows")


@query
def same_hour_lags_calendar(spark, sf_dir):
    return _lags(spark, sf_dir, "calendar")


def _order_lag(spark, sf_dir, mode):
    daily = sites.daily_orders(td.orders(spark, sf_dir))
    return _tidy(_doubles(features.order_day_lag(daily, mode=mode), ["lag7d_order_cnt"]))


@query
def order_day_lag(spark, sf_dir):
    return _order_lag(spark, sf_dir, "rows")


@query
def order_day_lag_calendar(spark, sf_dir):
    return _order_lag(spark, sf_dir, "calendar")


# ---- feature tables ----------------------------------------------------------------------


def _predict_features(spark, sf_dir):
    return features.hourly_features(
        td.hourly_labels(spark, sf_dir),
        _predict_sites(spark, sf_dir),
        td.vehicle_snapshots(spark, sf_dir),
        td.weather_workday(spark, sf_dir),
        PREDICT,
        features.PREDICT_HOURLY,
    )


def _train_features(spark, sf_dir):
    return features.hourly_features(
        td.hourly_labels(spark, sf_dir),
        _train_sites(spark, sf_dir),
        td.vehicle_snapshots(spark, sf_dir),
        None,
        TRAIN,
        features.TRAIN_HOURLY,
    )


@query
def hourly_features(spark, sf_dir):
    return _tidy(_doubles(_predict_features(spark, sf_dir), features.PREDICT_COLUMNS))


@query
def hourly_features_train(spark, sf_dir):
    return _tidy(_doubles(_train_features(spark, sf_dir), features.TRAIN_COLUMNS))


def _packed(found):
    return sequences.pack_sequences(
        found, ["site_guid", "city_guid"], "dt", features.TRAIN_COLUMNS, TRAIN_STEPS, "hourly_features"
    )


def _train_packed(spark, sf_dir):
    return _packed(_train_features(spark, sf_dir))


def _packed_sites(found):
    """Sites with a whole training sequence, by a count of their hours instead of the sequences."""
    hours = found.groupBy("site_guid", "city_guid").agg(F.count("*").alias("n"))
    return hours.filter(F.col("n") >= TRAIN_STEPS).drop("n")


def _static(spark, sf_dir, found=None):
    return features.static_features(
        _packed_sites(_train_features(spark, sf_dir) if found is None else found),
        td.orders(spark, sf_dir),
        features.city_codes(td.known_cities(spark, sf_dir)),
        td.weather_workday(spark, sf_dir),
        TRAIN,
    )


@query
def static_features(spark, sf_dir):
    return _tidy(_doubles(_static(spark, sf_dir), features.DAILY_COLUMNS))


@query
def city_ids(spark, sf_dir):
    return _tidy(features.city_codes(td.known_cities(spark, sf_dir)))


@query
def onehot_static(spark, sf_dir):
    # three category slots fewer than cities, so that clamping happens
    types = features.feature_types(1)
    vectors = features.static_vector(_static(spark, sf_dir), types, reserve=0)
    return _tidy(vectors.select("site_guid", "pt", "static_vector", "clamped_ids"))


# ---- packed sequences --------------------------------------------------------------------


@query
def packed_sequences(spark, sf_dir):
    return _tidy(
        sequences.pack_sequences(
            _predict_features(spark, sf_dir),
            ["site_guid"],
            "dt",
            features.PREDICT_COLUMNS,
            PREDICT_STEPS,
        )
    )


@query
def sequence_join(spark, sf_dir):
    # written once by site: the sites, their days and their sequences come from it, and both sides of the join lie alike
    found = scratch.bucketed(_train_features(spark, sf_dir), "features", ["site_guid"])
    daily = sequences.pack_sequences(
        _static(spark, sf_dir, found), ["site_guid"], "pt", features.DAILY_COLUMNS, DAILY_STEPS, "static_features"
    )
    return _tidy(sequences.join_sequences(_packed(found), daily))


def _decoded(spark, sf_dir):
    return sequences.decode_sequences(td.encoded_matrices(spark, sf_dir), "features", 8, 8)


@query
def decoded_sequences(spark, sf_dir):
    good = sequences.accepted(_decoded(spark, sf_dir))
    steps = good.select("site_guid", F.posexplode("steps").alias("step", "v"))
    return _tidy(steps.select("site_guid", "step", F.posexplode("v").alias("feature", "value")))


@query
def sequence_rejects(spark, sf_dir):
    return sequences.rejected(_decoded(spark, sf_dir)).select("site_guid", "reject_reason")


def _numbered(spark, sf_dir):
    keys = td.encoded_matrices(spark, sf_dir).select("site_guid")
    return numbering.pages(numbering.row_numbers(keys, ["site_guid"]), BATCH)


@query
def batch_pages(spark, sf_dir):
    return _tidy(_numbered(spark, sf_dir))


@query
def batch_alignment(spark, sf_dir):
    paged = _numbered(spark, sf_dir)
    good = sites.keep_sites(paged, sequences.accepted(_decoded(spark, sf_dir)), "site_guid")
    return _tidy(sequences.alignment(paged, good, "site_guid", ["batch_id"], ("paged", "good")))


# ---- training samples --------------------------------------------------------------------

FLOW_TARGETS = {"y_10": 0, "y_16": 1, "y_21": 2}


def _flow_sequences(spark, sf_dir, name="features"):
    return sequences.pack_sequences(
        td.flow_steps(spark, sf_dir), ["station_id"], "hour", td.FLOW_FEATURES, name=name
    )


def _with_static(spark, sf_dir):
    """Hourly flow sequences with one static row (departures, weekday two days on) per day."""
    day = F.col("hour").cast("date")
    daily = (
        td.panel(spark, sf_dir)
        .groupBy("station_id", day.alias("day"))
        .agg(F.sum("outflow").alias("orders"))
        .withColumn("day_of_week", K.weekday_sunday1(F.date_add("day", 2)))
    )
    static = sequences.pack_sequences(
        daily, ["station_id"], "day", ["orders", "day_of_week"], name="static_rows"
    )
    return _flow_sequences(spark, sf_dir).join(static, "station_id", "left")


@query
def daily_samples_gap3(spark, sf_dir):
    return _tidy(
        samples.daily_samples(
            _with_static(spark, sf_dir), 14, FLOW_TARGETS, gap_days=3, static="static_rows"
        )
    )


def _open_samples(spark, sf_dir):
    return samples.daily_samples(_flow_sequences(spark, sf_dir), 7, {"y": 0})


@query
def daily_samples_gap0(spark, sf_dir):
    return _tidy(_open_samples(spark, sf_dir))


@query
def day_split(spark, sf_dir):
    parts = samples.split_days(_flow_sequences(spark, sf_dir), DAY_SPLITS)
    return _tidy(samples.daily_samples(parts, 1, {"y": 0}))


@query
def overlap_split(spark, sf_dir):
    parts = samples.split_days(
        _with_static(spark, sf_dir),
        OVERLAP_SPLITS,
        static="static_rows",
        static_splits=OVERLAP_STATIC,
    )
    return _tidy(
        samples.daily_samples(parts, 14, FLOW_TARGETS, gap_days=3, static="static_rows")
    )


def _windows(spark, sf_dir):
    return samples.sliding_windows(
        td.flow_steps(spark, sf_dir), "station_id", "hour", td.FLOW_FEATURES, PAST, FUTURE
    )


@query
def graph_windows(spark, sf_dir):
    return _tidy(_windows(spark, sf_dir).drop("samples"))


@query
def ratio_split(spark, sf_dir):
    parts = samples.ratio_split(_windows(spark, sf_dir), 0.6, 0.2)
    last = lambda c: F.element_at(c, -1)[0]
    return _tidy(
        parts.select("station_id", "sample_idx", "split", last("x").alias("x_last"), last("y").alias("y_last"))
    )


def _sample_counts(spark, sf_dir):
    return samples.sample_counts(td.panel(spark, sf_dir), "station_id", 7)


@query
def train_subsample(spark, sf_dir):
    ids = samples.sample_keys(_sample_counts(spark, sf_dir))
    return _tidy(numbering.fraction_exact(ids, ["station_id", "sample_idx"], 0.4, seed=7))


@query
def full_batches(spark, sf_dir):
    rows, total = samples.sample_rows(_sample_counts(spark, sf_dir), "station_id")
    return _tidy(numbering.pages(numbering.full_pages_only(rows, BATCH, total=total), BATCH))


@query
def decoder_context(spark, sf_dir):
    context = V.decoder_context("x", 24, 24, len(td.FLOW_FEATURES))
    return _tidy(
        _open_samples(spark, sf_dir).select("station_id", "sample_idx", context.alias("x_dec"))
    )


# ---- baselines, graph, scoring -----------------------------------------------------------


@query
def trend_seasonal(spark, sf_dir):
    steps = _open_samples(spark, sf_dir).select(
        "station_id", "sample_idx", F.posexplode(V.channel("x", 0)).alias("step", "value")
    )
    return _tidy(forecast.trend_seasonal(steps, ["station_id", "sample_idx"], "step", "value"))


@query
def position_features(spark, sf_dir):
    start = K.ntz(td.PANEL_START)
    position = F.timestamp_diff("HOUR", start, F.col("hour"))
    waves = {f"pe_{i}": V.position_wave("position", i, 8) for i in range(8)}
    steps = td.panel(spark, sf_dir).select("station_id", position.alias("position"))
    return _tidy(steps.withColumns(waves))


def _values_and_rides(spark, sf_dir):
    """Hourly departures, and the rides themselves, written once for all that is read from them."""
    ends = ["started_at", "ended_at", "start_station_id", "end_station_id"]
    found = scratch.staged(td.rides(spark, sf_dir).select(ends), "rides")
    return td.panel_of(found).select("station_id", "hour", "outflow"), found


@query
def khop_flow(spark, sf_dir):
    values, found = _values_and_rides(spark, sf_dir)
    return _tidy(graph.khop(values, [td.edges_of(found)], "station_id", "hour", "outflow"))


@query
def khop_supports(spark, sf_dir):
    """Two hops over three edge sets: ride shares, the same rides backwards, shares between unequal stations."""
    values, found = _values_and_rides(spark, sf_dir)
    shares = scratch.staged(td.edges_of(found), "shares").dropna(subset=["src"])
    back = shares.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    apart = shares.filter("src != dst")
    return _tidy(graph.khop(values, [shares, back, apart], "station_id", "hour", "outflow"))


@query
def edge_softmax(spark, sf_dir):
    return _tidy(graph.edge_softmax(td.edges(spark, sf_dir), "weight"), 9)


@query
def lag_regression(spark, sf_dir):
    return _tidy(forecast.lag_regression(_future(spark, sf_dir), "station_id", "hour", "future_12h_outflow"))


def _outflow_samples(spark, sf_dir):
    """A week of hourly departures and those of the day after."""
    cut = samples.daily_samples(_flow_sequences(spark, sf_dir), 7, {"y": OUTFLOW})
    return cut.withColumn("x", V.channel("x", OUTFLOW))


@query
def linear_gram(spark, sf_dir):
    ready = _outflow_samples(spark, sf_dir).select("x", "y")
    return _tidy(forecast.gram_cells(ready, "x", "y"))


@query
def linear_forecast(spark, sf_dir):
    """Fitted on the first samples of every station, scored on the others, next to their truth."""
    last = F.array(F.element_at("x", -1))
    ready = _outflow_samples(spark, sf_dir).select("station_id", "sample_idx", last.alias("last"), "y")
    train = F.col("sample_idx") < TRAIN_SAMPLES
    weights, offsets = forecast.fit_linear(ready.filter(train), "last", "y", 24)
    test = ready.filter(~train).withColumn("id", F.concat_ws("|", "station_id", "sample_idx"))
    scored = forecast.score_sites(
        test.withColumn("steps", F.array("last")),
        lambda: forecast.linear_scorer(weights, offsets),
        1,
        1,
        targets=("y_pred",),
        key="id",
    )
    both = test.join(scored, "id").select(
        "station_id", "sample_idx", F.posexplode(F.arrays_zip("y", "y_pred")).alias("hour", "v")
    )
    return _tidy(both.select("station_id", "sample_idx", "hour", F.col("v.y").alias("y_true"), "v.y_pred"))


def _fitted_forecast(spark, sf_dir, x, steps, kernel, **how):
    """Fitted to the peak-weighted loss on the first samples of every station, scored on the others."""
    ready = scratch.staged(_outflow_samples(spark, sf_dir).select("station_id", "sample_idx", x.alias("x"), "y"), "samples")
    train = F.col("sample_idx") < TRAIN_SAMPLES
    scorer = forecast.decomposed_scorer(forecast.fit_decomposed(ready.filter(train), kernel=kernel, **how), kernel)
    test = ready.filter(~train).withColumn("id", F.concat_ws("|", "station_id", "sample_idx"))
    encoded = test.withColumn("steps", F.transform("x", lambda v: F.array(v)))
    scored = forecast.score_sites(encoded, lambda: scorer, steps, 1, targets=("y_pred",), key="id")
    both = test.join(scored, "id").select(
        "station_id", "sample_idx", F.posexplode(F.arrays_zip("y", "y_pred")).alias("hour", "v")
    )
    return both.select("station_id", "sample_idx", "hour", F.col("v.y").alias("y_true"), F.col("v.y_pred").alias("y_pred"))


@query
def weekly_forecast(spark, sf_dir):
    """A week of departures, in a seasonal and a trend part, to those of the day after."""
    return _tidy(_fitted_forecast(spark, sf_dir, F.col("x"), 7 * 24, 49), 4)


@query
def robust_lag_forecast(spark, sf_dir):
    """The same loss on the last value alone."""
    last = F.array(F.element_at("x", -1))
    return _tidy(_fitted_forecast(spark, sf_dir, last, 1, 1, ridge=0.0, rounds=4), 5)


def _scored(spark, sf_dir):
    steps = 7 * 24
    encoded = sequences.pack_sequences(
        td.flow_steps(spark, sf_dir), ["station_id"], "hour", td.FLOW_FEATURES, steps
    ).withColumn("features", F.to_json("features"))
    decoded = sequences.decode_sequences(encoded, "features", steps, len(td.FLOW_FEATURES))
    return forecast.score_sites(
        sequences.accepted(decoded),
        forecast.same_hour_mean,
        steps,
        len(td.FLOW_FEATURES),
        key="station_id",
    )


@query
def score_sites(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    zipped = F.posexplode(F.arrays_zip(*publish.TARGETS)).alias("hour", "v")
    return _tidy(scored.select("station_id", zipped).select("station_id", "hour", "v.*"))


def _forecast_arrays(spark, sf_dir):
    """Arrays of 24, 20 and 30 fractional values per station, to be fitted to 24."""
    packed = _flow_sequences(spark, sf_dir)
    last = lambda i, n, f: F.transform(
        F.slice(V.channel("features", i), -n, n), lambda v: v * f
    )
    return packed.select(
        F.col("station_id").alias("id"),
        last(0, 24, 0.5).alias("pred_10"),
        last(2, 20, 0.3).alias("pred_16"),
        last(1, 30, 0.7).alias("pred_21"),
    )


@query
def published_hours(spark, sf_dir):
    counts = publish.whole_counts(_forecast_arrays(spark, sf_dir))
    fences = publish.current_fences(td.fence_dim(spark, sf_dir), PREDICT.yesterday)
    return _tidy(publish.hourly_rows(counts, fences))


@query
def published_json(spark, sf_dir):
    return publish.json_rows(publish.whole_counts(_forecast_arrays(spark, sf_dir)))


# ---- metrics -----------------------------------------------------------------------------


@query
def slice_metrics(spark, sf_dir):
    return _tidy(metrics.slice_metrics(td.forecast_eval(spark, sf_dir), ["target"]))


@query
def daily_metrics(spark, sf_dir):
    return _tidy(metrics.daily_metrics(td.forecast_eval(spark, sf_dir)))


@query
def mean_daily_metrics(spark, sf_dir):
    return _tidy(metrics.mean_of_days(metrics.daily_metrics(td.forecast_eval(spark, sf_dir))))


@query
def peak_huber(spark, sf_dir):
    return _tidy(metrics.peak_huber(td.forecast_eval(spark, sf_dir), ["target", "day_idx"]))


@query
def multi_target_loss(spark, sf_dir):
    weights = {0: 1.0, 1: 0.5, 2: 2.0}
    return _tidy(metrics.multi_target_loss(td.forecast_eval(spark, sf_dir), weights))


@query
def overall_error(spark, sf_dir):
    return _tidy(metrics.overall_error(td.forecast_eval(spark, sf_dir), ["target"]))


@query
def averaged_loss(spark, sf_dir):
    return _tidy(metrics.averaged_loss(td.forecast_eval(spark, sf_dir), "day_idx", ["target"]))


@query
def horizon_metrics(spark, sf_dir):
    return _tidy(metrics.horizon_metrics(td.forecast_eval(spark, sf_dir), by=["target"]))


@query
def mean_horizon_metrics(spark, sf_dir):
    per = metrics.horizon_metrics(td.forecast_eval(spark, sf_dir), by=["target"], mask_zero=False)
    return _tidy(metrics.mean_over_horizons(per, ["target"]))


# ---- profiles ----------------------------------------------------------------------------


@query
def data_range(spark, sf_dir):
    return _tidy(profile.data_range(td.ride_starts(spark, sf_dir)))


@query
def hour_profile(spark, sf_dir):
    counts = profile.calendar_counts(td.rides(spark, sf_dir))
    return _tidy(_doubles(profile.hour_profile(counts), ["inflow", "outflow", "net_flow"]))


@query
def weekday_profile(spark, sf_dir):
    counts = profile.calendar_counts(td.rides(spark, sf_dir))
    return _tidy(_doubles(profile.weekday_profile(counts), ["inflow", "outflow", "net_flow"]))


def _totals(spark, sf_dir):
    return profile.station_totals(td.rides(spark, sf_dir), td.DAYS)


@query
def station_totals(spark, sf_dir):
    return _tidy(_totals(spark, sf_dir))


@query
def station_stats(spark, sf_dir):
    return _tidy(profile.station_stats(_totals(spark, sf_dir), (100, 1000), 2))


@query
def outflow_histogram(spark, sf_dir):
    return _tidy(profile.outflow_histogram(_totals(spark, sf_dir), at_least=120))


@query
def netflow_histogram(spark, sf_dir):
    return _tidy(profile.netflow_histogram(_totals(spark, sf_dir), reach=3))


@query
def top_stations(spark, sf_dir):
    return _tidy(profile.top_stations(_totals(spark, sf_dir)).select("station_id", "total_outflow"))


@query
def peak_hours(spark, sf_dir):
    return _tidy(profile.peak_hours(td.rides(spark, sf_dir)))


@query
def daily_volume(spark, sf_dir):
    return _tidy(profile.daily_volume(td.rides(spark, sf_dir)))


@query
def daily_volume_stats(spark, sf_dir):
    return _tidy(profile.volume_stats(profile.daily_volume(td.rides(spark, sf_dir))))


@query
def panel_quality(spark, sf_dir):
    lagged = features.panel_lags(_busy_flow(spark, sf_dir))
    lags = [f"net_flow_12h_lag_{d}d" for d in features.PANEL_LAG_DAYS]
    return _tidy(profile.completeness(lagged, "station_id", lags))


@query
def ride_nulls(spark, sf_dir):
    return _tidy(profile.null_counts(td.rides(spark, sf_dir)))


@query
def value_counts(spark, sf_dir):
    return _tidy(profile.value_counts(td.ride_starts(spark, sf_dir)))


@query
def panel_shape(spark, sf_dir):
    return _tidy(profile.shape_row(td.panel(spark, sf_dir)))


@query
def panel_head(spark, sf_dir):
    return _tidy(profile.preview(td.panel(spark, sf_dir), ["station_id", "hour"]))


@query
def station_ranking(spark, sf_dir):
    """Place of every station, most departures first."""
    ranked = profile.ranking(_totals(spark, sf_dir))
    return _tidy(ranked.select("rank", "station_id", "total_outflow"))


# ---- keys and raw rows -------------------------------------------------------------------


@query
def shifted_keys(spark, sf_dir):
    """Day keys a day before and after, and hour keys of two days before."""
    day = K.day_key("ts").alias("pt")
    rows = td.departures(spark, sf_dir).select("event_id", day, F.hour("ts").alias("hour"))
    return _tidy(
        rows.select(
            "event_id",
            K.hour_key("pt", "hour").alias("dt"),
            K.shifted_hour_key("pt", "hour").alias("dt_2d_before"),
            K.shift_day_key("pt", -1).alias("pt_before"),
            K.shift_day_key("pt", 1).alias("pt_after"),
            K.weekday_monday0(K.day_of_key("pt")).alias("weekday"),
        )
    )


@query
def stacked_rides(spark, sf_dir):
    """Two sources with their columns in another order, times as text, stacked and typed."""
    events = td.departures(spark, sf_dir)
    text = F.when(F.col("event_id") % 9 == 4, "no time").otherwise(F.col("ts").cast("string"))
    rides = events.select("event_id", text.alias("started_at"), "start_station_id")
    even = rides.filter("event_id % 2 = 0")
    odd = rides.filter("event_id % 2 = 1").select("start_station_id", "event_id", "started_at")
    return _tidy(readers.type_rides(even.unionByName(odd)))


@query
def numeric_ids(spark, sf_dir):
    """Numeric reading of ride types and station ids, null where they are no numbers."""
    ids = td.departures(spark, sf_dir)
    return _tidy(
        ids.select(
            "event_id",
            readers.numeric_if_possible("start_station_id").alias("station"),
            readers.numeric_if_possible("ride_type").alias("kind"),
        )
    )
