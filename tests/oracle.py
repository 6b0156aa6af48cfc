"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

# The driver's tables.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return repr(float(v)) if isinstance(v, (float, decimal.Decimal)) else str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return str(v)


def normal(columns, rows):
    """Columns by name, rows sorted, every cell as text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_result(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def sql_result(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return normal(names, cur.fetchall())


def difference(df, con, sql) -> str | None:
    """None if equal, else what differs first."""
    cols, rows = spark_result(df)
    want_cols, want = sql_result(con, sql)
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    if len(rows) != len(want):
        return f"{len(rows)} rows != {len(want)}; spark {rows[:2]} sql {want[:2]}"
    for a, b in zip(rows, want):
        if a != b:
            n = sum(x != y for x, y in zip(rows, want))
            return f"{n} rows differ of {len(rows)}, first: {a} != {b} {cols}"
    return None
