"""Order-insensitive comparison of result tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from workload.fixtures import BASE_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def rows_of_spark(df):
    return _normal(df.columns, [tuple(r) for r in df.collect()])


def rows_of_duck(con, sql):
    cur = con.execute(sql)
    return _normal([d[0] for d in cur.description], cur.fetchall())
