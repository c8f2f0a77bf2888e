"""Checks on series, weather and predictions. Reports are lazy tables; `require_*` raise."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.schema import DATE, HORIZON, MODEL_PERFORMANCE, PREDICTION, require_columns

# Limits of the freshness gates.
MAX_STALENESS_DAYS = 1
MIN_ROWS = 60
MAX_AGE_DAYS = 7


def _today(as_of: dt.date | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def freshness(
    df: DataFrame,
    as_of: dt.date | Column | None = None,
    max_staleness_days: int = MAX_STALENESS_DAYS,
    min_rows: int = MIN_ROWS,
    series_cols: Sequence[str] = (),
) -> DataFrame:
    """Last day, age in days, row count, and whether both limits hold."""
    stats = df.groupBy(*series_cols).agg(
        F.max(DATE).alias("last_date"), F.count("*").alias("n_rows")
    )
    age = F.datediff(_today(as_of), F.col("last_date"))
    return stats.select(
        *series_cols,
        "last_date",
        "n_rows",
        age.alias("staleness_days"),
        (age > max_staleness_days).alias("too_stale"),
        (F.col("n_rows") < min_rows).alias("too_few_rows"),
    )


def require_fresh(
    df: DataFrame,
    as_of: dt.date | Column | None = None,
    max_staleness_days: int = MAX_STALENESS_DAYS,
    min_rows: int = MIN_ROWS,
    series_cols: Sequence[str] = (),
) -> DataFrame:
    """Raise when any series is too old or too short; otherwise return the table."""
    report = freshness(df, as_of, max_staleness_days, min_rows, series_cols)
    counts = report.agg(
        F.count_if("too_stale").alias("stale"),
        F.count_if("too_few_rows").alias("short"),
        F.max("last_date").alias("last"),
        F.count("*").alias("n"),
    ).first()
    if counts.stale or counts.last is None:
        raise ValueError(f"{counts.stale} of {counts.n} series are stale, last day {counts.last}")
    if counts.short:
        raise ValueError(f"{counts.short} of {counts.n} series have fewer than {min_rows} rows")
    return df


def check_freshness(
    df: DataFrame,
    as_of: dt.date | Column | None = None,
    max_age_days: int = MAX_AGE_DAYS,
    series_cols: Sequence[str] = (),
) -> DataFrame:
    """Whether the newest day is at most `max_age_days` old."""
    stats = df.groupBy(*series_cols).agg(F.max(DATE).alias("last_date"))
    age = F.datediff(_today(as_of), F.col("last_date"))
    return stats.select(*series_cols, age.alias("age_days"), (age <= max_age_days).alias("is_fresh"))


def overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """Date ranges of two tables and whether they intersect, from one pass over each."""
    sides = left.select(DATE, F.lit("left").alias("_side")).unionByName(
        right.select(DATE, F.lit("right").alias("_side"))
    )
    is_left = F.col("_side") == "left"
    spans = sides.agg(
        F.min(F.when(is_left, F.col(DATE))).alias("left_first"),
        F.max(F.when(is_left, F.col(DATE))).alias("left_last"),
        F.min(F.when(~is_left, F.col(DATE))).alias("right_first"),
        F.max(F.when(~is_left, F.col(DATE))).alias("right_last"),
    )
    meets = (F.col("left_first") <= F.col("right_last")) & (F.col("left_last") >= F.col("right_first"))
    return spans.withColumn("overlaps", F.coalesce(meets, F.lit(False)))


def require_overlap(left: DataFrame, right: DataFrame) -> None:
    spans = overlap(left, right).first()
    if not spans.overlaps:
        raise ValueError(
            f"no common days: {spans.left_first}..{spans.left_last} and "
            f"{spans.right_first}..{spans.right_last}"
        )


def _broken(df: DataFrame, columns: Sequence[str]) -> Column:
    broken = F.lit(False)
    for c in columns:
        broken = broken | F.col(c).isNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            broken = broken | F.isnan(c)
    return broken


def prediction_rules(df: DataFrame) -> DataFrame:
    """Number of rows that break each rule for predictions: one pass, one row."""
    columns = PREDICTION.fieldNames()
    require_columns(df, columns, "predictions")
    point, low, high = F.col("point_prediction"), F.col("lower_bound"), F.col("upper_bound")
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(_broken(df, columns)).alias("n_null"),
        F.count_if(~F.col(HORIZON).between(1, 7)).alias("n_bad_horizon"),
        F.count_if((low > point) | (point > high)).alias("n_bad_bounds"),
    )


def validate_predictions(df: DataFrame) -> bool:
    """True when every prediction is complete, in range and inside its bounds; else raise."""
    try:
        broken = prediction_rules(df).first()
    except KeyError as error:
        raise ValueError(str(error)) from error
    if broken.n_null:
        raise ValueError(f"{broken.n_null} predictions have missing values")
    if broken.n_bad_horizon:
        raise ValueError(f"{broken.n_bad_horizon} predictions have a horizon outside 1..7")
    if broken.n_bad_bounds:
        raise ValueError(f"{broken.n_bad_bounds} predictions have invalid bounds")
    return True


def contract_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows that a table contract refuses: a NULL in a required column or a horizon outside 1..7."""
    require_columns(df, [f.name for f in schema if not f.nullable])
    refused = _broken(df, [f.name for f in schema if not f.nullable])
    return df.where(refused | ~F.col(HORIZON).between(1, 7))


def within_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows that the contract accepts."""
    required = [f.name for f in schema if not f.nullable]
    require_columns(df, required)
    return df.where(~_broken(df, required) & F.col(HORIZON).between(1, 7))


CONTRACTS = {"predictions": PREDICTION, "model_performance": MODEL_PERFORMANCE}
