"""Row-by-row comparison of Spark results with DuckDB results."""

from __future__ import annotations

import math

import duckdb

from claimweave.plans.bindings import BASE_TABLES


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def connect(folder):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in BASE_TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con
