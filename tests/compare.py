"""Comparison of a Spark result with the result of its SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    """One text form per value, whatever engine it comes from."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return f"bool:{value}"
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return rows_of(columns, cursor.fetchall())


def kinds_spark(df):
    return {name: kind for name, kind in df.dtypes}


def kinds_duck(con, sql):
    cursor = con.execute(f"DESCRIBE {sql}")
    return {row[0]: row[1] for row in cursor.fetchall()}
