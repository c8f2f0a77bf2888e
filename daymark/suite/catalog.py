"""Registration of queries and of the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; queries without SQL get a rows-only check."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column, as comparing across engines needs."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in doubles}) if doubles else df


def rounded_sql(sql: str, columns: Sequence[str], digits: int = 6) -> str:
    """The same on the SQL side. Adding 0.0 turns a negative zero into zero."""
    replaced = ", ".join(f'round("{c}", {digits}) + 0.0 AS "{c}"' for c in columns)
    return f"SELECT * REPLACE ({replaced}) FROM ({sql})"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)
