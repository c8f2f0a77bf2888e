"""From raw visit rows to a daily count series: duplicates, counting, filters, null rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.schema import DATE, KEY, TARGET, TIME, require_columns


def first_per_key(
    df: DataFrame, keys: Sequence[str], ingest_order: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the first in ingest order (by default the order of the scan).

    An aggregation rather than a ranked window: copies collapse before the shuffle, so a
    key with very many copies does not end up sorted in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    order = [F.col(c) for c in ingest_order] if ingest_order else [F.monotonically_increasing_id()]
    ranked = df.withColumn("_order", F.struct(*order))
    kept = ranked.groupBy(*keys).agg(F.min_by(F.struct(*rest), "_order").alias("_kept"))
    return kept.select(*[c if c in keys else F.col(f"_kept.`{c}`").alias(c) for c in df.columns])


def dedup_visits(
    df: DataFrame,
    keys: Sequence[str] = (KEY, TIME),
    series_cols: Sequence[str] = (),
    ingest_order: Sequence[str] | None = None,
) -> DataFrame:
    """Drop repeated visits; other columns follow the first row of each visit."""
    require_columns(df, [*series_cols, *keys], "visits")
    return first_per_key(df, [*series_cols, *keys], ingest_order)


def duplicate_profile(df: DataFrame, keys: Sequence[str] = (KEY, TIME)) -> DataFrame:
    """Rows, repeated rows and their share in percent."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    totals = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count("*").alias("_n_keys")
    )
    return totals.select(
        "n_rows",
        (F.col("n_rows") - F.col("_n_keys")).alias("n_duplicates"),
        F.try_divide((F.col("n_rows") - F.col("_n_keys")) * 100.0, F.col("n_rows")).alias(
            "duplicate_pct"
        ),
    )


def daily_counts(
    df: DataFrame,
    series_cols: Sequence[str] = (),
    as_of: dt.date | Column | None = None,
    time_col: str = TIME,
) -> DataFrame:
    """Visits per calendar day. With `as_of`, visits from that day on are left out before
    counting, which reaches the scan as a pushed filter."""
    require_columns(df, [*series_cols, time_col], "visits")
    visits = df.where(F.col(time_col).isNotNull())
    if as_of is not None:
        visits = visits.where(F.col(time_col) < _midnight(as_of))
    day = F.to_date(time_col).alias(DATE)
    return visits.groupBy(*series_cols, day).agg(F.count("*").alias(TARGET))


def _midnight(day: dt.date | Column) -> Column:
    if isinstance(day, Column):
        return day.cast("timestamp_ntz")
    return F.lit(dt.datetime.combine(day, dt.time())).cast("timestamp_ntz")


def filter_incomplete_day(df: DataFrame, as_of: dt.date | Column | None = None) -> DataFrame:
    """Keep finished days only (before `as_of`, by default today)."""
    today = F.current_date() if as_of is None else F.lit(as_of) if not isinstance(as_of, Column) else as_of
    return df.where(F.col(DATE) < today)


def filter_zero_days(df: DataFrame, target_col: str = TARGET) -> DataFrame:
    return df.where(F.col(target_col) > 0)


def series_profile(
    df: DataFrame, series_cols: Sequence[str] = (), target_col: str = TARGET
) -> DataFrame:
    """Number of days, first and last day, mean, lowest and highest count."""
    return df.groupBy(*series_cols).agg(
        F.count("*").alias("n_days"),
        F.min(DATE).alias("first_date"),
        F.max(DATE).alias("last_date"),
        F.avg(target_col).alias("mean_count"),
        F.min(target_col).alias("min_count"),
        F.max(target_col).alias("max_count"),
    )


def sort_by_date(df: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """Reporting order. Only for output: no operator relies on the order of its input."""
    return df.orderBy(*series_cols, DATE)


def _missing(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    absent = F.col(f"`{column}`").isNull()
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        absent = absent | F.isnan(f"`{column}`")
    return absent


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows with any missing value (NULL or NaN)."""
    return df.dropna("any")


def null_profile(df: DataFrame) -> DataFrame:
    """Per column the number of missing values, and the number of rows with any."""
    columns = df.columns
    counts = [F.count_if(_missing(df, c)).alias(c) for c in columns]
    any_missing = F.lit(False)
    for c in columns:
        any_missing = any_missing | _missing(df, c)
    one_row = df.agg(*counts, F.count_if(any_missing).alias("_any"), F.count("*").alias("_rows"))
    return one_row.unpivot(["_rows", "_any"], columns, "column_name", "n_missing").select(
        "column_name",
        "n_missing",
        F.col("_any").alias("rows_affected"),
        F.col("_rows").alias("n_rows"),
    )
