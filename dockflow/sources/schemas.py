"""Explicit schemas of every source and sink (fixed values: column names of the tables)."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# ---- sources ---------------------------------------------------------------------------

ORDERS = _schema(order_id=_S, site_guid=_S, capacity=_L, pt=_S)
#: Columns of the order table that have other names here.
ORDER_NAMES = {"bike_start_park_guid": "site_guid", "start_parking_capacity": "capacity"}
HOURLY_LABELS = _schema(
    site_guid=_S, city_guid=_S, label_10=_D, label_16=_D, label_21=_D, hour=_I, pt=_S
)
VEHICLE_SNAPSHOTS = _schema(
    parking_guid=_S, put_veh_cnt=_L, idle_12h_cnt=_L, idle_1d_cnt=_L, hr=_S, min=_S, pt=_S
)
WEATHER_WORKDAY = _schema(
    city_guid=_S,
    forecast_date=_S,
    pred_date=_S,
    cycle_weather_level=_I,
    temperature_avg_val=_D,
    workday_level=_I,
)
FENCE_DIM = _schema(fence_id=_S, city_guid=_S, area_status=_I, area_type=_I, pt=_S)
CITY_MAPPING = _schema(city_guid=_S, city_guid_encoded=_L)

# ---- sinks -----------------------------------------------------------------------------

PREDICT_FEATURES = _schema(site_guid=_S, features=_S, pt=_S)
TRAIN_FEATURES = _schema(
    site_guid=_S, city_guid=_S, hourly_features=_S, static_features=_S, pt=_S
)
HOURLY_PREDICTIONS = _schema(
    parking_guid=_S, city_guid=_S, pred_10=_L, pred_16=_L, pred_21=_L, hour=_S, pt=_S
)
JSON_PREDICTIONS = _schema(
    id=_S,
    period_10_netout_json=_S,
    period_16_netout_json=_S,
    period_21_netout_json=_S,
    pt=_S,
)
