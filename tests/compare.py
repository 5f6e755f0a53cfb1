"""Run registered queries against their SQL on a second engine and compare row by row."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _kind(value) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    return type(value).__name__


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def _table(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple], set]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = sorted(tuple(_cell(r[i]) for i in order) for r in rows)
    kinds = {(columns[i], _kind(r[i])) for r in rows for i in order if r[i] is not None}
    return [columns[i] for i in order], cells, kinds


def compare(spark, con, query, sql: str, sf_dir: str) -> tuple[str | None, int]:
    """First difference (None if equal) and the number of rows."""
    df = query(spark, sf_dir)
    mine = _table(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    theirs = _table([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}", len(mine[1])
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} != {len(theirs[1])}", len(mine[1])
    if mine[2] != theirs[2]:
        return f"types {sorted(mine[2] ^ theirs[2])}", len(mine[1])
    unlike = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    if unlike:
        a, b = unlike[0]
        cells = [(c, x[:160], y[:160]) for c, x, y in zip(mine[0], a, b) if x != y]
        return f"{len(unlike)} rows differ, e.g. {cells[:3]}", len(mine[1])
    return None, len(mine[1])


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from dockflow.session import build_session

    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark = build_session(
        "compare",
        "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
         "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or list(queries):
        start = time.time()
        if name not in oracle:
            print(f"{name}: no oracle", flush=True)
            continue
        try:
            difference, rows = compare(spark, con, queries[name], oracle[name], sf_dir)
        except Exception as error:  # noqa: BLE001
            difference, rows = f"error {str(error)[:500]}", 0
        failed += difference is not None
        print(f"{name}: {rows} rows {time.time() - start:.1f}s {difference or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
