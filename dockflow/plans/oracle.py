"""The registered queries in plain SQL over the same tables, for a second engine.

Written from the meaning of each query, not from its Spark plan: joins against spines, full
outer merges and grouped lists where the library generates, unpivots or slices.
"""

from __future__ import annotations

from dockflow.operators import features as ft
from dockflow.plans import queries as q
from dockflow.sources import adapters as td

# ---- common table expressions, each naming those it reads ---------------------------------

_LAG_SQL = {
    f"lag{k}d_{label[-2:]}": (label, k) for k in ft.LAG_DAYS for label in ft.LABELS
}


def _lags(cast: str = "DOUBLE") -> str:
    return ", ".join(
        f"lag({label}, {k}) OVER w AS {name}" for name, (label, k) in _LAG_SQL.items()
    )


def _zeros(columns, default="0") -> str:
    return ", ".join(f"CAST(coalesce({c}, {default}) AS DOUBLE) AS {c}" for c in columns)


def _vec(columns) -> str:
    return "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in columns) + "]"


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "departures": (
        (),
        f"""SELECT event_id, ts, user_id, event_type AS ride_type, value,
            CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) AS station
          FROM events""",
    ),
    "rides": (
        ("departures",),
        """SELECT event_id AS ride_id, ride_type, ts AS started_at, lead(ts) OVER w AS ended_at,
            station AS start_station_id, lead(station) OVER w AS end_station_id
          FROM departures WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    ),
    "outflow": (
        ("rides",),
        """SELECT start_station_id AS station_id, date_trunc('hour', started_at) AS hour,
            count(*) AS outflow
          FROM rides WHERE started_at IS NOT NULL AND start_station_id IS NOT NULL GROUP BY 1, 2""",
    ),
    "inflow": (
        ("rides",),
        """SELECT end_station_id AS station_id, date_trunc('hour', ended_at) AS hour,
            count(*) AS inflow
          FROM rides WHERE ended_at IS NOT NULL AND end_station_id IS NOT NULL GROUP BY 1, 2""",
    ),
    "hourly": (
        ("outflow", "inflow"),
        """SELECT station_id, hour, coalesce(inflow, 0) AS inflow, coalesce(outflow, 0) AS outflow
          FROM inflow FULL JOIN outflow USING (station_id, hour)""",
    ),
    "spine": (
        (),
        f"""SELECT unnest(generate_series(TIMESTAMP '{td.PANEL_START}',
            TIMESTAMP '{td.PANEL_END}', INTERVAL 1 HOUR)) AS hour""",
    ),
    "panel": (
        ("hourly", "spine"),
        """SELECT s.station_id, p.hour, coalesce(h.inflow, 0) AS inflow,
            coalesce(h.outflow, 0) AS outflow
          FROM (SELECT DISTINCT station_id FROM hourly) s CROSS JOIN spine p
          LEFT JOIN hourly h ON h.station_id = s.station_id AND h.hour = p.hour""",
    ),
    "ahead": (
        ("panel",),
        """SELECT station_id, hour,
            CASE WHEN count(*) OVER w = 12 THEN sum(inflow) OVER w END AS future_12h_inflow,
            CASE WHEN count(*) OVER w = 12 THEN sum(outflow) OVER w END AS future_12h_outflow
          FROM panel
          WINDOW w AS (PARTITION BY station_id ORDER BY hour
                       ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING)""",
    ),
    "future": (
        ("ahead",),
        f"""SELECT station_id, CAST(CAST(hour AS DATE) AS VARCHAR) AS date, hour,
            CAST(hour(hour) AS BIGINT) AS hour_of_day,
            CAST(future_12h_inflow AS BIGINT) AS future_12h_inflow,
            CAST(future_12h_outflow AS BIGINT) AS future_12h_outflow,
            CAST(future_12h_inflow - future_12h_outflow AS BIGINT) AS future_12h_netflow
          FROM ahead WHERE hour <= TIMESTAMP '{q.PANEL_CUTOFF}'""",
    ),
    "orders_": (
        ("departures",),
        """SELECT CAST(event_id AS VARCHAR) AS order_id, station AS site_guid,
            CAST(floor(value) AS BIGINT) AS capacity, strftime(ts, '%Y%m%d') AS pt
          FROM departures""",
    ),
    "daily": (
        ("orders_",),
        """SELECT site_guid, pt, count(order_id) AS daily_order_cnt,
            max(capacity) AS parking_capacity
          FROM orders_ GROUP BY 1, 2""",
    ),
    "activity": (
        ("daily",),
        f"""SELECT site_guid, max(daily_order_cnt) AS max_daily_orders,
            avg(daily_order_cnt) AS mean_daily_orders
          FROM daily WHERE pt BETWEEN '20240117' AND '20240130'
          GROUP BY 1""",
    ),
    "max_sites": (
        ("activity",),
        f"SELECT site_guid FROM activity WHERE max_daily_orders >= {q.MAX_ORDERS}",
    ),
    "mean_sites": (
        ("activity",),
        f"SELECT site_guid FROM activity WHERE mean_daily_orders >= {q.MEAN_ORDERS}",
    ),
    "train_sites": (
        ("max_sites", "mean_sites"),
        "SELECT site_guid FROM max_sites UNION SELECT site_guid FROM mean_sites",
    ),
    "busy": (
        ("rides",),
        f"""SELECT start_station_id AS station_id FROM (
            SELECT start_station_id, CAST(started_at AS DATE) AS day, count(*) AS n FROM rides
            WHERE started_at >= TIMESTAMP '{q.BUSY_RANGE[0]}'
              AND started_at < TIMESTAMP '{q.BUSY_RANGE[1]}' GROUP BY 1, 2)
          GROUP BY 1 HAVING avg(n) >= {q.MEAN_ORDERS}""",
    ),
    "busy_flow": (
        ("future", "busy"),
        "SELECT * FROM future WHERE station_id IN (SELECT station_id FROM busy)",
    ),
    "lagged": (
        ("busy_flow",),
        "SELECT *, "
        + ", ".join(
            f"lag(future_12h_netflow, {24 * d}) OVER w AS net_flow_12h_lag_{d}d"
            for d in ft.PANEL_LAG_DAYS
        )
        + " FROM busy_flow WINDOW w AS (PARTITION BY station_id ORDER BY hour)",
    ),
    "labels_": (
        ("panel",),
        f"""SELECT station_id AS site_guid,
            CAST(CAST(station_id AS INTEGER) % {td.CITIES} AS VARCHAR) AS city_guid,
            CAST(net AS DOUBLE) AS label_10,
            CAST(n6 AS DOUBLE) AS label_16, CAST(n12 AS DOUBLE) AS label_21,
            CAST(hour(hour) AS BIGINT) AS hour, strftime(hour, '%Y%m%d') AS pt
          FROM (SELECT *, outflow - inflow AS net,
              sum(outflow - inflow) OVER (PARTITION BY station_id ORDER BY hour
                ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS n6,
              sum(outflow - inflow) OVER (PARTITION BY station_id ORDER BY hour
                ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING) AS n12
            FROM panel)
          WHERE outflow > 0""",
    ),
    "snapshots": (
        ("departures",),
        """SELECT station AS parking_guid, strftime(ts, '%Y%m%d%H') AS dt,
            count(*) FILTER (ride_type = 'view') AS put_veh_cnt,
            count(*) FILTER (ride_type = 'error') AS idle_12h_cnt,
            count(*) FILTER (ride_type = 'click') AS idle_1d_cnt
          FROM departures WHERE minute(ts) < 30 GROUP BY 1, 2""",
    ),
    "weather": (
        ("departures",),
        f"""SELECT city_guid, strftime(day, '%Y%m%d') AS forecast_date,
            strftime(day + CAST(ahead AS INTEGER), '%Y%m%d') AS pred_date, cycle_weather_level,
            round(mean_value + (ahead - 1), 1) AS temperature_avg_val,
            CASE dayofweek(day) WHEN 0 THEN 0 WHEN 6 THEN 2 ELSE 1 END AS workday_level
          FROM (SELECT CAST(CAST(station AS INTEGER) % {td.CITIES} AS VARCHAR) AS city_guid,
              CAST(ts AS DATE) AS day,
              count(*) FILTER (ride_type = 'signup') % 4 AS cycle_weather_level,
              round(avg(value), 1) AS mean_value
            FROM departures GROUP BY 1, 2)
          CROSS JOIN (VALUES (1), (2)) a(ahead)""",
    ),
    "predict_features": (
        ("labels_", "max_sites", "snapshots", "weather"),
        f"""SELECT l.site_guid, l.city_guid, l.pt || lpad(CAST(l.hour AS VARCHAR), 2, '0') AS dt,
            {_zeros(["label_10", "label_16", "label_21", "put_veh_cnt", *_LAG_SQL])},
            CAST(coalesce(w.cycle_weather_level, 2) AS DOUBLE) AS cycle_weather_level,
            CAST(coalesce(w.temperature_avg_val, 25) AS DOUBLE) AS temperature_avg_val,
            CAST(coalesce(w.workday_level, 1) AS DOUBLE) AS workday_level,
            CAST(dayofweek(strptime(l.pt, '%Y%m%d')) + 1 AS DOUBLE) AS day_of_week,
            CAST(l.hour AS DOUBLE) AS hour
          FROM (SELECT *, {_lags()} FROM labels_
                WHERE pt BETWEEN '20240106' AND '20240130'
                  AND site_guid IN (SELECT site_guid FROM max_sites)
                WINDOW w AS (PARTITION BY site_guid, hour ORDER BY pt)) l
          LEFT JOIN snapshots s
            ON s.parking_guid = l.site_guid AND s.dt = l.pt || lpad(CAST(l.hour AS VARCHAR), 2, '0')
          LEFT JOIN (SELECT city_guid, forecast_date,
                arg_min(cycle_weather_level, pred_date) AS cycle_weather_level,
                arg_min(temperature_avg_val, pred_date) AS temperature_avg_val,
                arg_min(workday_level, pred_date) AS workday_level
              FROM weather
              WHERE forecast_date BETWEEN '20240119'
                AND '20240201' GROUP BY 1, 2) w
            ON w.city_guid = l.city_guid AND w.forecast_date = l.pt
          WHERE l.pt BETWEEN '20240117' AND '20240130'""",
    ),
    "train_features": (
        ("labels_", "train_sites", "snapshots"),
        f"""SELECT l.site_guid, l.city_guid, l.pt || lpad(CAST(l.hour AS VARCHAR), 2, '0') AS dt,
            {_zeros(["label_10", "label_16", "label_21",
                     "put_veh_cnt", "idle_12h_cnt", "idle_1d_cnt", *_LAG_SQL])},
            CAST(l.hour AS DOUBLE) AS hour
          FROM (SELECT *, {_lags()} FROM labels_
                WHERE pt BETWEEN '20231223' AND '20240130'
                  AND site_guid IN (SELECT site_guid FROM train_sites)
                WINDOW w AS (PARTITION BY site_guid, hour ORDER BY pt)) l
          LEFT JOIN snapshots s
            ON s.parking_guid = l.site_guid AND s.dt = l.pt || lpad(CAST(l.hour AS VARCHAR), 2, '0')
          WHERE l.pt BETWEEN '20240103' AND '20240130'""",
    ),
    "train_packed": (
        ("train_features",),
        f"""SELECT site_guid, city_guid,
            CAST(to_json(list({_vec(ft.TRAIN_COLUMNS)} ORDER BY dt)) AS VARCHAR) AS hourly_features
          FROM (SELECT *, row_number() OVER (PARTITION BY site_guid ORDER BY dt DESC) AS rn
                FROM train_features)
          WHERE rn <= {q.TRAIN_STEPS} GROUP BY 1, 2 HAVING count(*) = {q.TRAIN_STEPS}""",
    ),
    "codes": (
        (),
        f"""SELECT city_guid, row_number() OVER (ORDER BY city_guid) - 1 AS city_guid_encoded
          FROM (SELECT DISTINCT CAST(n_nationkey % {td.CITIES - 1} AS VARCHAR) AS city_guid
                FROM nation)""",
    ),
    "static_": (
        ("train_packed", "daily", "codes", "weather"),
        f"""SELECT p.site_guid, p.city_guid, strftime(p.day + 2, '%Y%m%d') AS pt,
            CAST(coalesce(d.lag7d_order_cnt, 0) AS DOUBLE) AS lag7d_order_cnt,
            CAST(coalesce(d.parking_capacity, 0) AS DOUBLE) AS parking_capacity,
            CAST(coalesce(w.temperature_avg_val, 20) AS DOUBLE) AS temperature_avg_val,
            CAST(coalesce(c.city_guid_encoded, (SELECT count(*) FROM codes)) AS DOUBLE)
              AS city_guid_encoded,
            CAST(dayofweek(p.day + 2) + 1 AS DOUBLE) AS day_of_week,
            CAST(coalesce(w.workday_level, 1) AS DOUBLE) AS workday_level,
            CAST(coalesce(w.cycle_weather_level, 2) AS DOUBLE) AS cycle_weather_level
          FROM (SELECT site_guid, city_guid, CAST(day AS DATE) AS day FROM train_packed
                CROSS JOIN (SELECT unnest(generate_series(
                  strptime('20240117', '%Y%m%d'),
                  strptime('20240128', '%Y%m%d'), INTERVAL 1 DAY)) AS day)) p
          LEFT JOIN (SELECT *, lag(daily_order_cnt, 5) OVER (PARTITION BY site_guid ORDER BY pt)
                  AS lag7d_order_cnt
                FROM daily WHERE pt >= '20240107' AND pt <= '20240128') d
            ON d.site_guid = p.site_guid AND d.pt = strftime(p.day, '%Y%m%d')
          LEFT JOIN codes c ON c.city_guid = p.city_guid
          LEFT JOIN (SELECT city_guid, pred_date,
                arg_min(cycle_weather_level, forecast_date) AS cycle_weather_level,
                arg_min(temperature_avg_val, forecast_date) AS temperature_avg_val,
                arg_min(workday_level, forecast_date) AS workday_level
              FROM weather
              WHERE pred_date BETWEEN
                  '20240118'
                AND '20240129'
              GROUP BY 1, 2) w
            ON w.city_guid = p.city_guid AND w.pred_date = strftime(p.day + 2, '%Y%m%d')""",
    ),
    "flow_steps": (
        ("panel",),
        f"""SELECT station_id, hour, outflow, inflow,
            date_diff('hour', TIMESTAMP '{td.PANEL_START}', hour) AS step,
            [CAST(inflow - outflow AS DOUBLE), CAST(inflow AS DOUBLE), CAST(outflow AS DOUBLE),
             CAST(hour(hour) AS DOUBLE)] AS vec
          FROM panel""",
    ),
    "static_rows": (
        ("panel",),
        """SELECT station_id, date_diff('day', DATE '2024-01-01', day) AS day_idx,
            [CAST(n AS DOUBLE), CAST(dayofweek(day + 2) + 1 AS DOUBLE)] AS vec
          FROM (SELECT station_id, CAST(hour AS DATE) AS day, sum(outflow) AS n
                FROM panel GROUP BY 1, 2)""",
    ),
    "open_samples": (
        ("flow_steps",),
        f"""SELECT a.station_id, i.sample_idx,
            list(a.vec ORDER BY a.step) FILTER (a.step < (i.sample_idx + 7) * 24) AS x,
            list(a.vec[1] ORDER BY a.step) FILTER (a.step >= (i.sample_idx + 7) * 24) AS y
          FROM flow_steps a JOIN (SELECT unnest(range({td.DAYS - 10})) AS sample_idx) i
            ON a.step >= i.sample_idx * 24 AND a.step < (i.sample_idx + 8) * 24
          GROUP BY 1, 2""",
    ),
    "cells": (
        ("flow_steps",),
        f"""SELECT station_id, sample_idx,
            CASE WHEN step - sample_idx * 24 < 168 THEN step - sample_idx * 24
              ELSE step - sample_idx * 24 + 1 END AS i, CAST(outflow AS DOUBLE) AS v
          FROM flow_steps JOIN (SELECT unnest(range({td.DAYS - 10})) AS sample_idx)
            ON step >= sample_idx * 24 AND step < (sample_idx + 8) * 24
          UNION ALL SELECT DISTINCT station_id, unnest(range({td.DAYS - 10})), 168, 1 FROM flow_steps""",
    ),
    "ends": (
        ("cells",),
        """SELECT a.station_id, a.sample_idx, a.v AS x, b.i - 169 AS hour, b.v AS y
          FROM cells a JOIN cells b USING (station_id, sample_idx) WHERE a.i = 167 AND b.i > 168""",
    ),
    "windows": (
        ("flow_steps",),
        f"""SELECT a.station_id, i.sample_idx,
            list(a.vec ORDER BY a.step) FILTER (a.step < i.sample_idx + {q.PAST}) AS x,
            list(a.vec ORDER BY a.step) FILTER (a.step >= i.sample_idx + {q.PAST}) AS y
          FROM flow_steps a
          JOIN (SELECT unnest(range({td.DAYS * 24 - q.PAST - q.FUTURE + 1})) AS sample_idx) i
            ON a.step >= i.sample_idx AND a.step < i.sample_idx + {q.PAST + q.FUTURE}
          GROUP BY 1, 2""",
    ),
    "matrices": (
        (),
        """SELECT CAST(vec_id AS VARCHAR) AS site_guid, vec_id,
            list_transform(embedding, lambda v: round(CAST(v AS DOUBLE), 4)) AS flat,
            CASE WHEN vec_id % 17 = 16 THEN 'bad_json' WHEN vec_id % 7 = 6 THEN 'bad_length'
              WHEN vec_id % 11 = 10 THEN 'bad_width' WHEN vec_id % 13 = 12 THEN 'bad_value' END
              AS reject_reason
          FROM embeddings""",
    ),
    "paged": (
        ("matrices",),
        f"""SELECT site_guid, reject_reason, row_number() OVER (ORDER BY site_guid) AS row_id,
            (row_number() OVER (ORDER BY site_guid) - 1) // {q.BATCH} AS batch_id
          FROM matrices""",
    ),
    "edges_": (
        ("rides",),
        """SELECT src, dst, n / total AS weight FROM (
            SELECT start_station_id AS src, end_station_id AS dst, count(*) AS n FROM rides
            GROUP BY 1, 2)
          JOIN (SELECT start_station_id AS src, count(*) AS total FROM rides GROUP BY 1) USING (src)
          WHERE dst IS NOT NULL""",
    ),
    "targets": (
        ("ahead",),
        """SELECT station_id, hour, 0 AS target, future_12h_outflow AS v FROM ahead
          UNION ALL SELECT station_id, hour, 1, future_12h_inflow FROM ahead
          UNION ALL SELECT station_id, hour, 2, future_12h_inflow - future_12h_outflow FROM ahead""",
    ),
    "eval": (
        ("targets",),
        """SELECT t.station_id AS site, CAST(t.target AS BIGINT) AS target,
            date_diff('day', DATE '2024-01-01', CAST(t.hour AS DATE)) - 1 AS day_idx,
            CAST(hour(t.hour) AS BIGINT) AS hour,
            CAST(t.v AS DOUBLE) AS y_true, CAST(p.v + 0.5 AS DOUBLE) AS y_pred
          FROM targets t JOIN targets p ON p.station_id = t.station_id AND p.target = t.target
            AND p.hour = t.hour - INTERVAL 1 DAY
          WHERE t.v IS NOT NULL AND p.v IS NOT NULL""",
    ),
    "losses": (
        ("eval",),
        """SELECT *, abs(y_pred - y_true) AS e, y_true >= 5 AS peak,
            CASE WHEN abs(y_pred - y_true) <= 5 THEN 0.5 * (y_pred - y_true) ** 2
              ELSE 5 * (abs(y_pred - y_true) - 2.5) END AS huber
          FROM eval""",
    ),
    "totals": (
        ("rides",),
        f"""SELECT o.station_id, o.n AS total_outflow, coalesce(i.n, 0) AS total_inflow,
            o.n / {td.DAYS} AS avg_daily_outflow, coalesce(i.n, 0) - o.n AS net_flow
          FROM (SELECT start_station_id AS station_id, count(*) AS n FROM rides
                WHERE start_station_id IS NOT NULL GROUP BY 1) o
          LEFT JOIN (SELECT end_station_id AS station_id, count(*) AS n FROM rides GROUP BY 1) i
            USING (station_id)""",
    ),
    "by_hour": (
        ("rides",),
        """SELECT o.h AS hour_of_day, o.n AS outflow, i.n AS inflow
          FROM (SELECT hour(started_at) AS h, count(*) AS n FROM rides
                WHERE started_at IS NOT NULL GROUP BY 1) o
          LEFT JOIN (SELECT hour(ended_at) AS h, count(*) AS n FROM rides
                WHERE ended_at IS NOT NULL GROUP BY 1) i USING (h)""",
    ),
    "by_weekday": (
        ("rides",),
        """SELECT c.weekday, c.day_name, o.n AS outflow, i.n AS inflow
          FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'),
                (4, 'Friday'), (5, 'Saturday'), (6, 'Sunday')) c(weekday, day_name)
          LEFT JOIN (SELECT dayname(started_at) AS day_name, count(*) AS n FROM rides GROUP BY 1) o
            USING (day_name)
          LEFT JOIN (SELECT dayname(ended_at) AS day_name, count(*) AS n FROM rides GROUP BY 1) i
            USING (day_name)""",
    ),
    "volume": (
        ("rides",),
        """SELECT CAST(CAST(ended_at AS DATE) AS VARCHAR) AS day, count(*) AS order_count
          FROM rides WHERE ended_at IS NOT NULL GROUP BY 1""",
    ),
}


CTES["days_"] = (
    ("labels_",),
    "SELECT *, CAST(strptime(pt, '%Y%m%d') AS DATE) - DATE '2024-01-01' AS day FROM labels_",
)


def _hops(edges: str) -> tuple[tuple[str, ...], str]:
    """Sums after one hop (k = 1) and after two."""
    hop = """SELECT e.dst AS station_id, v.hour, sum(e.weight * v.outflow) AS outflow
      FROM {source} v JOIN ({edges}) e ON e.src = v.station_id GROUP BY 1, 2"""
    once, twice = (hop.format(source=s, edges=edges) for s in ("panel", "once"))
    return ("panel", "edges_"), f"""WITH once AS MATERIALIZED ({once}), twice AS MATERIALIZED ({twice})
      SELECT 1 AS k, * FROM once UNION ALL SELECT 2 AS k, * FROM twice"""


CTES["hops_forth"] = _hops("SELECT * FROM edges_")
CTES["hops_back"] = _hops("SELECT dst AS src, src AS dst, weight FROM edges_ WHERE src IS NOT NULL")
CTES["hops_apart"] = _hops("SELECT * FROM edges_ WHERE src != dst")


def _with(body: str, *names: str) -> str:
    """``body`` preceded by the expressions it reads, in order of dependence."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in CTES[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in ordered) + "\n" + body


def _r(expression: str, name: str, digits: int = 6) -> str:
    return f"round(CAST({expression} AS DOUBLE), {digits}) AS {name}"


def _big(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)


def _json(expression: str, name: str) -> str:
    return f"CAST(to_json({expression}) AS VARCHAR) AS {name}"


def _samples(seq_days: int, gap: int, first: int, end: int, static_first: int = 0) -> str:
    """Three-target samples of the day range ``first``..``end`` by joining steps to samples."""
    count = end - first - seq_days - 3
    label = seq_days + gap
    y = ", ".join(
        f"CAST(to_json(list(a.vec[{i}] ORDER BY a.step) FILTER (a.step >= "
        f"({first} + i.sample_idx + {label}) * 24)) AS VARCHAR) AS {name}"
        for i, name in ((1, "y_10"), (2, "y_16"), (3, "y_21"))
    )
    return f"""SELECT a.station_id, CAST(i.sample_idx AS BIGINT) AS sample_idx,
        CAST(to_json(list(a.vec ORDER BY a.step) FILTER
          (a.step < ({first} + i.sample_idx + {seq_days}) * 24)) AS VARCHAR) AS x,
        {y}, CAST(to_json(any_value(s.vec)) AS VARCHAR) AS static
      FROM flow_steps a JOIN (SELECT unnest(range({count})) AS sample_idx) i
        ON a.step >= ({first} + i.sample_idx) * 24
        AND a.step < ({first} + i.sample_idx + {label + 1}) * 24
      JOIN static_rows s ON s.station_id = a.station_id
        AND s.day_idx = {static_first} + i.sample_idx
      GROUP BY 1, 2"""


def _open_split(first: int, end: int) -> str:
    return f"""SELECT a.station_id, CAST(i.sample_idx AS BIGINT) AS sample_idx,
        CAST(to_json(list(a.vec ORDER BY a.step) FILTER
          (a.step < ({first} + i.sample_idx + 1) * 24)) AS VARCHAR) AS x,
        CAST(to_json(list(a.vec[1] ORDER BY a.step) FILTER
          (a.step >= ({first} + i.sample_idx + 1) * 24)) AS VARCHAR) AS y
      FROM flow_steps a JOIN (SELECT unnest(range({end - first - 4})) AS sample_idx) i
        ON a.step >= ({first} + i.sample_idx) * 24 AND a.step < ({first} + i.sample_idx + 2) * 24
      GROUP BY 1, 2"""


def _union(parts: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS split, * FROM ({s})" for n, s in parts.items())


def _metric_slices(
    group: str, slices: dict, mask: str, pred: str, wanted: dict, digits: int = 6
) -> str:
    parts = []
    for name, (first, last) in slices.items():
        keep = f"{mask} AND hour BETWEEN {first} AND {last}"
        measures = {
            "mse": f"avg(({pred} - y_true) ** 2) FILTER ({keep})",
            "mape": f"avg(abs(({pred} - y_true) / nullif(y_true, 0))) FILTER ({keep})",
            "wmape": f"sum(abs({pred} - y_true)) FILTER ({keep})"
            f" / nullif(sum(abs(y_true)) FILTER ({keep}), 0)",
        }
        columns = ", ".join(_r(measures[m], alias, digits) for m, alias in wanted.items())
        parts.append(
            f"SELECT {group}, '{name}' AS slice, {columns}, count(*) FILTER ({keep}) AS rows"
            f" FROM eval GROUP BY {group}"
        )
    return " UNION ALL ".join(parts)




def _daily(digits: int = 6) -> str:
    return _metric_slices(
        "target, day_idx",
        {"day": (0, 23), "morning": (8, 8), "afternoon": (13, 13), "evening": (19, 19)},
        "y_true >= 5",
        "round_even(y_pred, 0)",
        {"mape": "mape", "wmape": "wape"},
        digits,
    )


_PEAK_HUBER = (
    "2 * coalesce(avg(huber) FILTER (peak), 0) + coalesce(avg(e) FILTER (NOT peak), 0)"
)


def _histogram(column: str, bins: int, lo: str, hi: str) -> str:
    return f"""SELECT CAST(bin AS BIGINT) AS bin, {_r(f"lo + (hi - lo) / {bins} * bin", "bin_start")},
        {_r(f"lo + (hi - lo) / {bins} * (bin + 1)", "bin_end")}, count(*) AS count
      FROM (SELECT lo, hi, least(floor(({column} - lo) * {bins} / (hi - lo)), {bins - 1}) AS bin
            FROM totals, (SELECT CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi FROM totals))
      GROUP BY bin, lo, hi"""


def _waves(width: int) -> str:
    columns = []
    for i in range(width):
        fn = "cos" if i % 2 else "sin"
        columns.append(
            _r(f"{fn}(position * exp(-{i - i % 2} * ln(10000.0) / {width}))", f"pe_{i}")
        )
    return ", ".join(columns)


def _khop(columns: dict[str, str]) -> str:
    shown = ", ".join(_r(f"coalesce({t}.outflow, 0)", name) for name, t in columns.items())
    joins = " ".join(
        f"LEFT JOIN (SELECT * FROM hops_{ {'f': 'forth', 'b': 'back', 'a': 'apart'}[t[0]] } WHERE k = {t[1]}) {t} "
        "USING (station_id, hour)"
        for t in columns.values()
    )
    return f"SELECT p.station_id, p.hour, CAST(p.outflow AS DOUBLE) AS outflow, {shown} FROM panel p {joins}"


def _robust_lag(rounds: int) -> str:
    """Weighted regressions per hour, each weighted by the errors of the one before."""
    parts = [
        "train AS MATERIALIZED (SELECT * FROM ends WHERE sample_idx < 14)",
        """shares AS (SELECT 2.0 / greatest(1, count(*) FILTER (y >= 5)) AS p,
          1.0 / greatest(1, count(*) FILTER (y < 5)) AS n FROM train)""",
        "w0 AS MATERIALIZED (SELECT hour, x, y, CASE WHEN y >= 5 THEN p ELSE n END AS w FROM train, shares)",
    ]
    for k in range(rounds):
        parts.append(
            f"""f{k} AS MATERIALIZED (SELECT hour, slope, (swy - slope * swx) / sw AS intercept FROM (
              SELECT *, (sw * swxy - swx * swy) / (sw * swxx - swx * swx) AS slope FROM (
                SELECT hour, sum(w) AS sw, sum(w * x) AS swx, sum(w * y) AS swy, sum(w * x * x) AS swxx,
                  sum(w * x * y) AS swxy FROM w{k} GROUP BY 1)))"""
        )
        parts.append(
            f"""w{k + 1} AS MATERIALIZED (SELECT hour, x, y, CASE WHEN y >= 5 THEN p * least(1, 5 / greatest(e, 5))
              ELSE n / greatest(e, 1) END AS w
              FROM (SELECT t.*, abs(y - slope * x - intercept) AS e FROM train t JOIN f{k} USING (hour)), shares)"""
        )
    chain = ",\n".join(parts)
    return f"""SELECT * FROM (WITH {chain}
      SELECT t.station_id, CAST(t.sample_idx AS BIGINT) AS sample_idx, CAST(t.hour AS BIGINT) AS hour,
        CAST(t.y AS DOUBLE) AS y_true, {_r("f.slope * t.x + f.intercept", "y_pred", 5)}
      FROM ends t JOIN f{rounds - 1} f USING (hour) WHERE t.sample_idx >= 14)"""


ORACLE: dict[str, str] = {
    "hourly_outflow": _with("SELECT * FROM outflow", "outflow"),
    "hourly_inflow": _with("SELECT * FROM inflow", "inflow"),
    "hourly_flow": _with("SELECT * FROM hourly", "hourly"),
    "dense_panel": _with("SELECT * FROM panel", "panel"),
    "future_12h_flow": _with("SELECT * FROM future", "future"),
    "active_sites": _with(
        f"""SELECT site_guid, max_daily_orders, {_r("mean_daily_orders", "mean_daily_orders")}
          FROM activity WHERE site_guid IN (SELECT site_guid FROM train_sites)""",
        "activity",
        "train_sites",
    ),
    "site_union": _with("SELECT * FROM train_sites", "train_sites"),
    "active_site_flow": _with("SELECT * FROM busy_flow", "busy_flow"),
    "panel_lags": _with(
        f"""SELECT station_id, hour,
          {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ft.PANEL_COLUMNS)}
          FROM lagged WHERE hour >= TIMESTAMP '{q.LAG_CUTOFF}'""",
        "lagged",
    ),
    "panel_sequences": _with(
        f"""SELECT station_id, {_json(f"list({_vec(ft.PANEL_COLUMNS)} ORDER BY hour)", "features")}
          FROM lagged WHERE hour >= TIMESTAMP '{q.LAG_CUTOFF}' GROUP BY 1""",
        "lagged",
    ),
    "same_hour_lags": _with(
        f"""SELECT site_guid, city_guid, label_10, label_16, label_21, hour, pt, {_zeros(_LAG_SQL)}
          FROM (SELECT *, {_lags()} FROM labels_
                WINDOW w AS (PARTITION BY site_guid, hour ORDER BY pt))
          WHERE pt BETWEEN '20240117' AND '20240130'""",
        "labels_",
    ),
    "same_hour_lags_calendar": _with(
        f"""SELECT l.site_guid, l.city_guid, l.label_10, l.label_16, l.label_21, l.hour, l.pt,
            {", ".join(f"coalesce(max(p.{c}) FILTER (l.day - p.day = {k}), 0) AS {n}" for n, (c, k) in _LAG_SQL.items())}
          FROM days_ l LEFT JOIN days_ p ON p.site_guid = l.site_guid AND p.hour = l.hour
            AND l.day - p.day IN ({", ".join(map(str, ft.LAG_DAYS))})
          WHERE l.pt BETWEEN '20240117' AND '20240130' GROUP BY ALL""",
        "days_",
    ),
    "order_day_lag": _with(
        """SELECT site_guid, pt, daily_order_cnt, parking_capacity,
            CAST(lag(daily_order_cnt, 5) OVER (PARTITION BY site_guid ORDER BY pt) AS DOUBLE)
              AS lag7d_order_cnt
          FROM daily""",
        "daily",
    ),
    "order_day_lag_calendar": _with(
        """SELECT d.*, CAST(p.daily_order_cnt AS DOUBLE) AS lag7d_order_cnt FROM daily d
          LEFT JOIN daily p ON p.site_guid = d.site_guid
            AND p.pt = strftime(strptime(d.pt, '%Y%m%d') - INTERVAL 5 DAY, '%Y%m%d')""",
        "daily",
    ),
    "hourly_features": _with("SELECT * FROM predict_features", "predict_features"),
    "hourly_features_train": _with("SELECT * FROM train_features", "train_features"),
    "static_features": _with("SELECT * FROM static_", "static_"),
    "city_ids": _with(f"SELECT city_guid, {_big('city_guid_encoded')} FROM codes", "codes"),
    "onehot_static": _with(
        f"""SELECT site_guid, pt, {_json('''
            list_transform(range(8), lambda i: CAST(i = day_of_week AS DOUBLE))
            || list_transform(range(3), lambda i: CAST(i = workday_level AS DOUBLE))
            || [least(city_guid_encoded, 1.0), least(cycle_weather_level, 3.0)]
            || [lag7d_order_cnt, parking_capacity, temperature_avg_val]''', "static_vector")},
            CAST(CAST(city_guid_encoded >= 2 AS INTEGER) + CAST(cycle_weather_level >= 4 AS INTEGER)
              AS BIGINT) AS clamped_ids
          FROM static_""",
        "static_",
    ),
    "packed_sequences": _with(
        f"""SELECT site_guid, {_json(f"list({_vec(ft.PREDICT_COLUMNS)} ORDER BY dt)", "features")}
          FROM (SELECT *, row_number() OVER (PARTITION BY site_guid ORDER BY dt DESC) AS rn
                FROM predict_features)
          WHERE rn <= {q.PREDICT_STEPS} GROUP BY 1 HAVING count(*) = {q.PREDICT_STEPS}""",
        "predict_features",
    ),
    "sequence_join": _with(
        f"""SELECT h.*, d.static_features FROM train_packed h LEFT JOIN (
            SELECT site_guid, {_json(f"list({_vec(ft.DAILY_COLUMNS)} ORDER BY pt)", "static_features")}
            FROM (SELECT *, row_number() OVER (PARTITION BY site_guid ORDER BY pt DESC) AS rn
                  FROM static_)
            WHERE rn <= {q.DAILY_STEPS} GROUP BY 1 HAVING count(*) = {q.DAILY_STEPS}) d
          USING (site_guid)""",
        "train_packed",
        "static_",
    ),
    "decoded_sequences": _with(
        """SELECT site_guid, CAST(i // 8 AS BIGINT) AS step, CAST(i % 8 AS BIGINT) AS feature,
            flat[i + 1] AS value
          FROM matrices, (SELECT unnest(range(64)) AS i) WHERE reject_reason IS NULL""",
        "matrices",
    ),
    "sequence_rejects": _with(
        "SELECT site_guid, reject_reason FROM matrices WHERE reject_reason IS NOT NULL", "matrices"
    ),
    "batch_pages": _with(f"SELECT site_guid, {_big('row_id', 'batch_id')} FROM paged", "paged"),
    "batch_alignment": _with(
        f"""SELECT {_big("batch_id")}, count(*) FILTER (reject_reason IS NULL) AS "both",
            count(*) FILTER (reject_reason IS NOT NULL) AS paged_only,
            CAST(0 AS BIGINT) AS good_only
          FROM paged GROUP BY batch_id""",
        "paged",
    ),
    "daily_samples_gap3": _with(_samples(14, 3, 0, td.DAYS), "flow_steps", "static_rows"),
    "daily_samples_gap0": _with(
        f"""SELECT station_id, {_big("sample_idx")}, {_json("x", "x")}, {_json("y", "y")}
          FROM open_samples""",
        "open_samples",
    ),
    "day_split": _with(
        _union({n: _open_split(*r) for n, r in q.DAY_SPLITS.items()}), "flow_steps"
    ),
    "overlap_split": _with(
        _union(
            {
                n: _samples(14, 3, *r, static_first=q.OVERLAP_STATIC[n][0])
                for n, r in q.OVERLAP_SPLITS.items()
            }
        ),
        "flow_steps",
        "static_rows",
    ),
    "graph_windows": _with(
        f"""SELECT station_id, {_big("sample_idx")}, {_json("x", "x")}, {_json("y", "y")}
          FROM windows""",
        "windows",
    ),
    "ratio_split": _with(
        f"""SELECT station_id, {_big("sample_idx")},
            CASE WHEN sample_idx < round_even(0.6 * n, 0) THEN 'train'
              WHEN sample_idx >= n - round_even(0.2 * n, 0) THEN 'test' ELSE 'val' END AS split,
            x[{q.PAST}][1] AS x_last, y[{q.FUTURE}][1] AS y_last
          FROM windows, (SELECT count(DISTINCT sample_idx) AS n FROM windows)""",
        "windows",
    ),
    "train_subsample": _with(
        f"""SELECT station_id, {_big("sample_idx")} FROM (
            SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '7', station_id,
                CAST(sample_idx AS VARCHAR))), station_id, sample_idx) AS rn,
              count(*) OVER () AS n FROM open_samples)
          WHERE rn <= floor(0.4 * n)""",
        "open_samples",
    ),
    "full_batches": _with(
        f"""SELECT station_id, {_big("sample_idx", "row_id")},
            CAST((row_id - 1) // {q.BATCH} AS BIGINT) AS batch_id
          FROM (SELECT station_id, sample_idx,
              row_number() OVER (ORDER BY station_id, sample_idx) AS row_id,
              count(*) OVER () AS n FROM open_samples)
          WHERE row_id <= n // {q.BATCH} * {q.BATCH}""",
        "open_samples",
    ),
    "decoder_context": _with(
        f"""SELECT station_id, {_big("sample_idx")}, {_json('''
            list_transform(x[145:168], lambda s: [s[1], 0.0, 0.0, 0.0])
            || list_transform(range(24), lambda i: [0.0, 0.0, 0.0, 0.0])''', "x_dec")}
          FROM open_samples""",
        "open_samples",
    ),
    "linear_gram": _with(
        """SELECT CAST(a.i AS BIGINT) AS i, CAST(b.i AS BIGINT) AS j, sum(a.v * b.v) AS value
          FROM (SELECT * FROM cells WHERE i <= 168) a JOIN cells b USING (station_id, sample_idx)
          GROUP BY 1, 2""",
        "cells",
    ),
    "linear_forecast": _with(
        f"""SELECT t.station_id, CAST(t.sample_idx AS BIGINT) AS sample_idx,
            CAST(t.hour AS BIGINT) AS hour, t.y AS y_true,
            round(f.slope * t.x + f.intercept, 6) AS y_pred
          FROM ends t JOIN (SELECT hour, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept
            FROM ends WHERE sample_idx < 14 GROUP BY 1) f USING (hour)
          WHERE t.sample_idx >= 14""",
        "ends",
    ),
    "robust_lag_forecast": _with(_robust_lag(4), "ends"),
    "trend_seasonal": _with(
        f"""SELECT a.station_id, {_big("sample_idx")}, CAST(a.step AS BIGINT) AS step,
            any_value(a.v) AS value, {_r("sum(b.v) / 49", "trend")},
            {_r("any_value(a.v) - sum(b.v) / 49", "seasonal")}
          FROM (SELECT station_id, sample_idx, unnest(range(168)) AS step,
                  unnest(list_transform(x, lambda s: s[1])) AS v FROM open_samples) a
          JOIN (SELECT station_id, sample_idx, k,
                  x[least(greatest(k, 0), 167) + 1][1] AS v
                FROM open_samples, (SELECT unnest(range(-24, 192)) AS k)) b
            USING (station_id, sample_idx)
          WHERE b.k BETWEEN a.step - 24 AND a.step + 24
          GROUP BY a.station_id, sample_idx, a.step""",
        "open_samples",
    ),
    "position_features": _with(
        f"""SELECT station_id, CAST(position AS BIGINT) AS position, {_waves(8)}
          FROM (SELECT station_id, step AS position FROM flow_steps)""",
        "flow_steps",
    ),
    "khop_flow": _with(_khop({"outflow_hop1": "f1", "outflow_hop2": "f2"}), "panel", "hops_forth"),
    "khop_supports": _with(
        _khop({f"outflow_hop{k}_s{i}": f"{s}{k}" for i, s in enumerate("fba") for k in (1, 2)}),
        "panel",
        "hops_forth",
        "hops_back",
        "hops_apart",
    ),
    "edge_softmax": _with(
        f"""SELECT src, dst, {_r("weight", "weight", 9)},
            {_r("p / sum(p) OVER (PARTITION BY src)", "attention", 9)}
          FROM (SELECT *, exp(weight - max(weight) OVER (PARTITION BY dst)) AS p FROM edges_)""",
        "edges_",
    ),
    "lag_regression": _with(
        f"""SELECT station_id, {_r("regr_slope(y, x)", "slope")},
            {_r("regr_intercept(y, x)", "intercept")}, CAST(regr_count(y, x) AS BIGINT) AS rows
          FROM (SELECT station_id, CAST(future_12h_outflow AS DOUBLE) AS y,
              CAST(lag(future_12h_outflow, 24) OVER (PARTITION BY station_id ORDER BY hour)
                AS DOUBLE) AS x
            FROM future) GROUP BY 1""",
        "future",
    ),
    "score_sites": _with(
        f"""SELECT station_id, CAST(hour(hour) AS BIGINT) AS hour, {_r("avg(vec[1])", "pred_10")},
            {_r("avg(vec[2])", "pred_16")}, {_r("avg(vec[3])", "pred_21")}
          FROM flow_steps WHERE step >= {(td.DAYS - 7) * 24} GROUP BY 1, 2""",
        "flow_steps",
    ),
    "published_hours": _with(
        f"""SELECT f.parking_guid, s.city_guid,
            CAST(coalesce(greatest(ceil(p10), 0), 0) AS BIGINT) AS pred_10,
            CAST(coalesce(greatest(ceil(p16), 0), 0) AS BIGINT) AS pred_16,
            CAST(coalesce(greatest(ceil(p21), 0), 0) AS BIGINT) AS pred_21,
            lpad(CAST(h AS VARCHAR), 2, '0') AS hour
          FROM (SELECT a.station_id AS parking_guid, h,
                max(a.vec[1] * 0.5) FILTER (a.step = {td.DAYS * 24 - 24} + h) AS p10,
                max(a.vec[3] * 0.3) FILTER (a.step = {td.DAYS * 24 - 20} + h) AS p16,
                max(a.vec[2] * 0.7) FILTER (a.step = {td.DAYS * 24 - 30} + h) AS p21
              FROM flow_steps a, (SELECT unnest(range(24)) AS h) GROUP BY 1, 2) f
          LEFT JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS fence_id,
                CAST(s_nationkey % {td.CITIES} AS VARCHAR) AS city_guid
              FROM supplier WHERE s_acctbal > 0) s ON s.fence_id = f.parking_guid""",
        "flow_steps",
    ),
    "published_json": _with(
        "SELECT id, "
        + ", ".join(
            f"CAST(json_object('period_{t}_netout', list(CAST(coalesce(greatest(ceil(p{t}), 0), 0)"
            f" AS BIGINT) ORDER BY h)) AS VARCHAR) AS period_{t}_netout_json"
            for t in (10, 16, 21)
        )
        + f""" FROM (SELECT a.station_id AS id, h,
                max(a.vec[1] * 0.5) FILTER (a.step = {td.DAYS * 24 - 24} + h) AS p10,
                max(a.vec[3] * 0.3) FILTER (a.step = {td.DAYS * 24 - 20} + h) AS p16,
                max(a.vec[2] * 0.7) FILTER (a.step = {td.DAYS * 24 - 30} + h) AS p21
              FROM flow_steps a, (SELECT unnest(range(24)) AS h) GROUP BY 1, 2) GROUP BY 1""",
        "flow_steps",
    ),
    "slice_metrics": _with(
        _metric_slices(
            "target",
            {"morning": (7, 9), "evening": (18, 20), "all_day": (0, 23)},
            "y_true > 5",
            "y_pred",
            {"mse": "mse", "mape": "mape", "wmape": "wmape"},
        ),
        "eval",
    ),
    "daily_metrics": _with(_daily(), "eval"),
    "mean_daily_metrics": _with(
        f"""SELECT target, slice, {_r("avg(mape)", "mape")}, {_r("avg(wape)", "wape")},
            count(*) FILTER (mape IS NULL) AS empty_days
          FROM ({_daily(15)}) GROUP BY 1, 2""",
        "eval",
    ),
    "peak_huber": _with(
        f"SELECT target, day_idx, {_r(_PEAK_HUBER, 'loss')}, count(*) AS rows"
        " FROM losses GROUP BY 1, 2",
        "losses",
    ),
    "multi_target_loss": _with(
        f"""SELECT target, {_r("loss", "loss")}, {_r("w * loss", "weighted_loss")},
            {_r("sum(w * loss) OVER ()", "total_loss")}
          FROM (SELECT target, {_PEAK_HUBER} AS loss,
              CASE target WHEN 1 THEN 0.5 WHEN 2 THEN 2.0 ELSE 1.0 END AS w
            FROM losses GROUP BY 1)""",
        "losses",
    ),
    "overall_error": _with(
        f"""SELECT target, {_r("avg(e)", "mae")}, {_r("sqrt(avg(e * e))", "rmse")},
            {_r("avg(e * e)", "mse")},
            {_r("avg(CASE WHEN e < 5 THEN 0.5 * e * e / 5 ELSE e - 2.5 END)", "smooth_l1")},
            count(*) AS rows
          FROM losses GROUP BY 1""",
        "losses",
    ),
    "averaged_loss": _with(
        f"""SELECT target, {_r("sum(loss * n) / sum(n)", "weighted_mean_loss")},
            {_r("avg(loss)", "batch_mean_loss")}, count(*) AS batches
          FROM (SELECT target, day_idx, {_PEAK_HUBER} AS loss, count(*) AS n
                FROM losses GROUP BY 1, 2) GROUP BY 1""",
        "losses",
    ),
    "horizon_metrics": _with(
        f"""SELECT target, hour, {_r("avg(e)", "mae")}, {_r("avg(e / abs(y_true))", "mape")},
            {_r("sqrt(avg(e * e))", "rmse")}
          FROM losses WHERE y_true <> 0 GROUP BY 1, 2""",
        "losses",
    ),
    "mean_horizon_metrics": _with(
        f"""SELECT target, {_r("avg(mae)", "mae")}, {_r("avg(mape)", "mape")}, {_r("avg(rmse)", "rmse")}
          FROM (SELECT target, hour, avg(e) AS mae, avg(e / abs(nullif(y_true, 0))) AS mape,
              sqrt(avg(e * e)) AS rmse FROM losses GROUP BY 1, 2) GROUP BY 1""",
        "losses",
    ),
    "data_range": _with(
        """SELECT count(*) AS rides, min(started_at) AS first_start, max(started_at) AS last_start,
            count(DISTINCT start_station_id) AS stations FROM rides""",
        "rides",
    ),
    "hour_profile": _with(
        """SELECT CAST(hour_of_day AS BIGINT) AS hour_of_day, CAST(outflow AS DOUBLE) AS outflow,
            CAST(inflow AS DOUBLE) AS inflow, CAST(inflow - outflow AS DOUBLE) AS net_flow
          FROM by_hour""",
        "by_hour",
    ),
    "weekday_profile": _with(
        """SELECT CAST(weekday AS BIGINT) AS weekday, day_name, CAST(outflow AS DOUBLE) AS outflow,
            CAST(inflow AS DOUBLE) AS inflow, CAST(inflow - outflow AS DOUBLE) AS net_flow
          FROM by_weekday""",
        "by_weekday",
    ),
    "station_totals": _with(
        f"""SELECT station_id, total_outflow, total_inflow,
            {_r("avg_daily_outflow", "avg_daily_outflow")}, net_flow FROM totals""",
        "totals",
    ),
    "station_stats": _with(
        f"""SELECT count(*) AS stations, {_r("avg(total_outflow)", "mean_outflow")},
            {_r("median(total_outflow)", "median_outflow")}, max(total_outflow) AS max_outflow,
            min(total_outflow) AS min_outflow,
            count(*) FILTER (total_outflow > 100) AS outflow_over_100,
            count(*) FILTER (total_outflow > 1000) AS outflow_over_1000,
            {_r("avg(net_flow)", "mean_netflow")}, max(net_flow) AS max_netflow,
            min(net_flow) AS min_netflow, count(*) FILTER (net_flow > 0) AS attracting,
            count(*) FILTER (net_flow < 0) AS sending, count(*) FILTER (net_flow > 2) AS extreme_in,
            count(*) FILTER (net_flow < -2) AS extreme_out
          FROM totals""",
        "totals",
    ),
    "outflow_histogram": _with(
        _histogram("total_outflow", 50, "0", "greatest(120, max(total_outflow))"), "totals"
    ),
    "netflow_histogram": _with(
        _histogram("net_flow", 60, "least(-3, min(net_flow))", "greatest(3, max(net_flow))"),
        "totals",
    ),
    "top_stations": _with(
        "SELECT station_id, total_outflow FROM totals ORDER BY total_outflow DESC, station_id LIMIT 10",
        "totals",
    ),
    "peak_hours": _with(
        """SELECT 'hour' AS kind,
            (SELECT CAST(hour_of_day AS VARCHAR) FROM by_hour ORDER BY outflow DESC, hour_of_day LIMIT 1)
              AS busiest, (SELECT max(outflow) FROM by_hour) AS largest,
            (SELECT CAST(hour_of_day AS VARCHAR) FROM by_hour ORDER BY outflow, hour_of_day LIMIT 1)
              AS quietest, (SELECT min(outflow) FROM by_hour) AS smallest
          UNION ALL SELECT 'weekday',
            (SELECT day_name FROM by_weekday WHERE outflow IS NOT NULL
             ORDER BY outflow DESC, weekday LIMIT 1),
            (SELECT max(outflow) FROM by_weekday),
            (SELECT day_name FROM by_weekday WHERE outflow IS NOT NULL
             ORDER BY outflow, weekday LIMIT 1),
            (SELECT min(outflow) FROM by_weekday)""",
        "by_hour",
        "by_weekday",
    ),
    "daily_volume": _with("SELECT * FROM volume", "volume"),
    "daily_volume_stats": _with(
        f"""SELECT {_r("avg(order_count)", "mean_orders")}, max(order_count) AS max_orders,
            min(order_count) AS min_orders, count(*) AS days FROM volume""",
        "volume",
    ),
    "panel_quality": _with(
        """SELECT count(*) AS keys, min(n) AS min_rows, max(n) AS max_rows,
            count(DISTINCT n) AS distinct_lengths, CAST(sum(n) AS BIGINT) AS rows, """
        + ", ".join(
            f"CAST(sum(n{d}) AS BIGINT) AS net_flow_12h_lag_{d}d_nulls" for d in ft.PANEL_LAG_DAYS
        )
        + " FROM (SELECT station_id, count(*) AS n, "
        + ", ".join(
            f"count(*) FILTER (net_flow_12h_lag_{d}d IS NULL) AS n{d}" for d in ft.PANEL_LAG_DAYS
        )
        + " FROM lagged GROUP BY 1)",
        "lagged",
    ),
    "ride_nulls": _with(
        "SELECT "
        + ", ".join(
            f"count(*) FILTER ({c} IS NULL) AS {c}_nulls"
            for c in (
                "ride_id", "ride_type", "started_at", "ended_at", "start_station_id", "end_station_id",
            )
        )
        + " FROM rides",
        "rides",
    ),
    "value_counts": _with(
        "SELECT "
        + ", ".join(
            f"count({c}) AS {n}_values"
            for c, n in (
                ("event_id", "ride_id"), ("ride_type", "ride_type"), ("ts", "started_at"),
                ("station", "start_station_id"),
            )
        )
        + " FROM departures",
        "departures",
    ),
    "panel_shape": _with("SELECT count(*) AS rows, CAST(4 AS BIGINT) AS columns FROM panel", "panel"),
    "panel_head": _with(
        f"""SELECT station_id, hour, {_big("inflow", "outflow")} FROM panel
          ORDER BY station_id, hour LIMIT 20""",
        "panel",
    ),
    "station_ranking": _with(
        """SELECT row_number() OVER (ORDER BY total_outflow DESC, station_id) AS rank, station_id,
            total_outflow FROM totals""",
        "totals",
    ),
    "shifted_keys": _with(
        """SELECT event_id, strftime(ts, '%Y%m%d%H') AS dt,
            strftime(ts - INTERVAL 2 DAY, '%Y%m%d%H') AS dt_2d_before,
            strftime(ts - INTERVAL 1 DAY, '%Y%m%d') AS pt_before,
            strftime(ts + INTERVAL 1 DAY, '%Y%m%d') AS pt_after,
            CAST((dayofweek(ts) + 6) % 7 AS BIGINT) AS weekday
          FROM departures""",
        "departures",
    ),
    "stacked_rides": _with(
        """SELECT event_id, CASE WHEN event_id % 9 <> 4 THEN ts END AS started_at,
            station AS start_station_id
          FROM departures""",
        "departures",
    ),
    "numeric_ids": _with(
        """SELECT event_id, TRY_CAST(station AS BIGINT) AS station, TRY_CAST(ride_type AS BIGINT) AS kind
          FROM departures""",
        "departures",
    ),
}
