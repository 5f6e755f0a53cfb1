"""Lags, defaults, dimension joins and the hourly and daily feature sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.functions import keys as K
from dockflow.functions import vectors as V
from dockflow.operators import sites
from dockflow.sources.readers import between_days, on_the_hour

# ---- fixed values: vector layouts, lag days and defaults of the feature tables -----------

LABELS = ("label_10", "label_16", "label_21")
LAG_DAYS = (1, 2, 3, 4, 11)
LAG_COLUMNS = tuple(f"lag{k}d_{label[-2:]}" for k in LAG_DAYS for label in LABELS)
WEATHER = ("cycle_weather_level", "temperature_avg_val", "workday_level")
PREDICT_COLUMNS = (
    *LABELS, "put_veh_cnt", *LAG_COLUMNS,
    "cycle_weather_level", "temperature_avg_val", "workday_level", "day_of_week", "hour",
)
TRAIN_COLUMNS = (*LABELS, "put_veh_cnt", "idle_12h_cnt", "idle_1d_cnt", *LAG_COLUMNS, "hour")
DAILY_COLUMNS = (
    "lag7d_order_cnt", "parking_capacity", "temperature_avg_val", "city_guid_encoded",
    "day_of_week", "workday_level", "cycle_weather_level",
)
PREDICT_WEATHER_DEFAULTS = {
    "cycle_weather_level": 2, "workday_level": 1, "temperature_avg_val": 25.0,
}
TRAIN_WEATHER_DEFAULTS = {
    "cycle_weather_level": 2, "workday_level": 1, "temperature_avg_val": 20.0,
}
PANEL_LAG_DAYS = (1, 2, 6, 13)
PANEL_COLUMNS = (
    "future_12h_netflow", "future_12h_inflow", "future_12h_outflow",
    "net_flow_12h_lag_1d", "net_flow_12h_lag_2d", "net_flow_12h_lag_6d", "net_flow_12h_lag_13d",
    "hour_of_day",
)


# ---- lags ------------------------------------------------------------------------------


def _day_number(day: Column) -> Column:
    return F.unix_date(day)


def day_lags(
    df: DataFrame,
    columns: Mapping[str, tuple[str, int]],
    keys: Sequence[str],
    day: Column,
    mode: str = "rows",
) -> DataFrame:
    """Lagged columns ``{name: (column, k)}`` within ``keys``, ordered by ``day``.

    ``rows``: the k-th row before, whatever its day (absent days shift the meaning).
    ``calendar``: the value exactly k days before, null if that day is absent.
    All columns share one window, thus one shuffle and one sort. A group holds one row per
    day; pre-aggregate if it does not.
    """
    if mode == "rows":
        window = W.partitionBy(*keys).orderBy(day)
        lagged = {n: F.lag(c, k).over(window) for n, (c, k) in columns.items()}
    elif mode == "calendar":
        window = W.partitionBy(*keys).orderBy(_day_number(day))
        lagged = {n: F.first(c).over(window.rangeBetween(-k, -k)) for n, (c, k) in columns.items()}
    else:
        raise ValueError(f"unknown lag mode {mode!r}")
    return df.select("*", *[c.alias(n) for n, c in lagged.items()])


def same_hour_lags(
    hourly: DataFrame, lags: Sequence[int] = LAG_DAYS, mode: str = "rows", site: str = "site_guid"
) -> DataFrame:
    """Label values of the same hour on earlier days, named ``lag<k>d_<label>``."""
    columns = {f"lag{k}d_{c[-2:]}": (c, k) for k in lags for c in LABELS}
    return day_lags(hourly, columns, [site, "hour"], K.day_of_key("pt"), mode)


def panel_lags(
    panel: DataFrame,
    column: str = "future_12h_netflow",
    days: Sequence[int] = PANEL_LAG_DAYS,
    per_day: int = 24,
    prefix: str = "net_flow_12h_lag",
    station: str = "station_id",
    time: str = "hour",
) -> DataFrame:
    """Lags by whole days of rows on a dense panel."""
    window = W.partitionBy(station).orderBy(time)
    return panel.select(
        "*", *[F.lag(column, per_day * d).over(window).alias(f"{prefix}_{d}d") for d in days]
    )


def order_day_lag(
    daily: DataFrame, rows: int = 5, mode: str = "rows", site: str = "site_guid"
) -> DataFrame:
    """Order count five order-days back: last week's weekday, seen from two days ahead."""
    lag = {"lag7d_order_cnt": ("daily_order_cnt", rows)}
    return day_lags(daily, lag, [site], K.day_of_key("pt"), mode)


# ---- nulls and defaults ------------------------------------------------------------------


def fill_numeric(df: DataFrame, value: float = 0) -> DataFrame:
    """Replace nulls in every numeric column; text stays."""
    return df.fillna(value)


def fill_defaults(df: DataFrame, defaults: Mapping[str, float]) -> DataFrame:
    """Replace nulls by a default per column, keeping the column types."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    filled = {
        c: F.coalesce(F.col(c), F.lit(v).cast(kinds[c])) for c, v in defaults.items() if c in kinds
    }
    return df.withColumns(filled)


def one_per_key(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], last: bool = False
) -> DataFrame:
    """One row per key: the first (or last) by ``order`` and, where that ties, by the columns."""
    pick = F.max_by if last else F.min_by
    chosen = df.groupBy(*keys).agg(pick(F.struct(*columns), F.struct(order, *columns)).alias("_v"))
    return chosen.select(*keys, "_v.*")


# ---- hourly features ---------------------------------------------------------------------


@dataclass(frozen=True)
class HourlySpec:
    """What the hourly feature table holds."""

    columns: Sequence[str] = PREDICT_COLUMNS
    snapshot_columns: Sequence[str] = ("put_veh_cnt",)
    with_weather: bool = True
    lags: Sequence[int] = LAG_DAYS
    lag_mode: str = "rows"
    weather_defaults: Mapping[str, float] = field(default_factory=lambda: PREDICT_WEATHER_DEFAULTS)


PREDICT_HOURLY = HourlySpec()
TRAIN_HOURLY = HourlySpec(
    columns=TRAIN_COLUMNS,
    snapshot_columns=("put_veh_cnt", "idle_12h_cnt", "idle_1d_cnt"),
    with_weather=False,
)


def join_snapshots(hourly: DataFrame, snapshots: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Left join on (site, hour key); several snapshots of one hour count as their maximum."""
    per_hour = (
        on_the_hour(snapshots)
        .groupBy(F.col("parking_guid").alias("site_guid"), "dt")
        .agg(*[F.max(c).alias(c) for c in columns])
    )
    return hourly.join(per_hour, ["site_guid", "dt"], "left")


def join_weather(
    df: DataFrame,
    weather: DataFrame,
    day: str,
    by: str,
    first: date,
    last: date,
    order: str,
) -> DataFrame:
    """Left join of weather and workday by (day, city); ``by`` is the weather day column."""
    per_key = one_per_key(between_days(weather, first, last, by), ["city_guid", by], order, WEATHER)
    return df.join(per_key.withColumnRenamed(by, day), [day, "city_guid"], "left")


def hourly_features(
    labels: DataFrame,
    active: DataFrame,
    snapshots: DataFrame,
    weather: DataFrame | None,
    dates: K.RunDates,
    spec: HourlySpec = PREDICT_HOURLY,
) -> DataFrame:
    """(site_guid, city_guid, dt) and the feature columns of ``spec`` for start..end.

    Lags are taken over the range plus its warm-up, which is then cut off.
    """
    window = between_days(labels, dates.warm_up_start, dates.end)
    lagged = same_hour_lags(sites.keep_sites(window, active, "site_guid"), spec.lags, spec.lag_mode)
    hourly = fill_numeric(between_days(lagged, dates.start, dates.end), 0).withColumns(
        {
            "dt": K.hour_key("pt", "hour"),
            "day_of_week": K.weekday_sunday1(K.day_of_key("pt")),
        }
    )
    joined = join_snapshots(
        hourly, between_days(snapshots, dates.start, dates.end), spec.snapshot_columns
    )
    defaults = {c: 0 for c in spec.snapshot_columns}
    if spec.with_weather:
        joined = join_weather(
            joined, weather, "pt", "forecast_date",
            *dates.weather_days, order="pred_date",
        )
        defaults |= spec.weather_defaults
    return fill_defaults(joined, defaults).select("site_guid", "city_guid", "dt", *spec.columns)


# ---- daily (static) features ---------------------------------------------------------------


def city_codes(cities: DataFrame) -> DataFrame:
    """Dense code per city in alphabetical order. The cities of a dimension fit one array."""
    known = cities.agg(F.array_sort(F.collect_set("city_guid")).alias("_cities"))
    return known.select(F.posexplode("_cities").alias("city_guid_encoded", "city_guid")).select(
        "city_guid", F.col("city_guid_encoded").cast("bigint").alias("city_guid_encoded")
    )


def encode_city(df: DataFrame, codes: DataFrame) -> DataFrame:
    """City code; cities without one get the next free code."""
    unknown = codes.agg(F.count("*")).scalar()
    return df.join(codes, "city_guid", "left").withColumn(
        "city_guid_encoded", F.coalesce("city_guid_encoded", unknown)
    )


def site_days(sites_df: DataFrame, first: date, last: date) -> DataFrame:
    """Every site on every day of first..last. The days are generated per row, not joined."""
    return sites_df.select("*", F.explode(K.day_spine(first, last)).alias("date"))


def static_features(
    sites_df: DataFrame,
    orders: DataFrame,
    codes: DataFrame,
    weather: DataFrame,
    dates: K.RunDates,
    defaults: Mapping[str, float] = TRAIN_WEATHER_DEFAULTS,
    lag_mode: str = "rows",
    warm_up_days: int = 10,
) -> DataFrame:
    """(site_guid, city_guid, pt) and the daily columns; ``pt`` is the day two days ahead."""
    first, last = dates.label_start, dates.label_end
    history = between_days(orders, K.days_after(first, -warm_up_days), last)
    daily = order_day_lag(sites.daily_orders(history), mode=lag_mode).select(
        "site_guid",
        K.day_of_key("pt").alias("date"),
        "lag7d_order_cnt",
        "parking_capacity",
    )
    ahead = F.date_add("date", 2)
    spine = site_days(sites_df, first, last).join(daily, ["site_guid", "date"], "left")
    coded = encode_city(spine, codes).withColumns(
        {"pt": K.day_key(ahead), "day_of_week": K.weekday_sunday1(ahead)}
    )
    joined = join_weather(
        coded, weather, "pt", "pred_date",
        *dates.label_weather_days, order="forecast_date",
    )
    return (
        fill_defaults(joined, {"lag7d_order_cnt": 0, "parking_capacity": 0, **defaults})
        .dropna(subset=["site_guid"])
        .select("site_guid", "city_guid", "pt", *DAILY_COLUMNS)
    )


# ---- typed static vector --------------------------------------------------------------------


def feature_types(cities: int) -> dict[str, tuple[str, str | None, int | None]]:
    """Kind, coding and size of every daily column, in vector order (fixed values)."""
    return {
        "lag7d_order_cnt": ("continuous", None, None),
        "parking_capacity": ("continuous", None, None),
        "temperature_avg_val": ("continuous", None, None),
        "city_guid_encoded": ("categorical", "embedding", cities + 1),
        "day_of_week": ("categorical", "onehot", 8),
        "workday_level": ("categorical", "onehot", 3),
        "cycle_weather_level": ("categorical", "embedding", 4),
    }


def static_vector(
    df: DataFrame, types: Mapping[str, tuple], reserve: int = 10, name: str = "static_vector"
) -> DataFrame:
    """One vector per row: one-hot codes, then category ids, then continuous values.

    Ids beyond ``size + reserve`` slots go to the last slot; ``clamped_ids`` counts them.
    """
    coded = lambda how: [(c, s[2]) for c, s in types.items() if s[1] == how]
    onehot, ids = coded("onehot"), coded("embedding")
    continuous = [c for c, s in types.items() if s[0] == "continuous"]
    parts = [V.one_hot(c, size) for c, size in onehot]
    parts.append(F.array(*[V.clamp_code(c, n + reserve).cast("double") for c, n in ids]))
    parts.append(V.vector(continuous))
    clamped = [V.is_clamped(c, n + reserve).cast("int") for c, n in ids]
    return df.withColumns(
        {name: F.concat(*parts), "clamped_ids": sum(clamped, F.lit(0))}
    )
