"""Spark result vs DuckDB oracle: column names, row count, row multiset.

Columns are compared by name (sorted), values after normalising types
(dates and timestamps to ISO text, -0.0 to 0.0, NaN to None).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return 0.0 if v == 0 else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return float(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = rel.fetchall()
    return [names[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in rows]


def compare(df, con, sql) -> tuple[bool, str]:
    s_cols, s_rows = spark_rows(df)
    d_cols, d_rows = duck_rows(con, sql)
    if s_cols != d_cols:
        return False, f"columns differ: spark-only {set(s_cols) - set(d_cols)}, duck-only {set(d_cols) - set(s_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark {len(s_rows)} duck {len(d_rows)}"
    cs, cd = Counter(s_rows), Counter(d_rows)
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        return False, f"values differ ({sum((cs - cd).values())} rows); cols {s_cols}\n spark {only_s}\n duck  {only_d}"
    return True, f"{len(s_rows)} rows"
