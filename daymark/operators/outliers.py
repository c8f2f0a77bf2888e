"""Outlier bounds per series and what to do with days outside them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.schema import DATE, TARGET, series_window, whole

METHODS = ("iqr", "percentile")
ACTIONS = ("flag", "cap", "remove")
# Quantiles of the two methods and the default width in interquartile ranges.
IQR_QUANTILES = (0.25, 0.75)
TAIL_QUANTILES = (0.01, 0.99)
IQR_MULTIPLIER = 2.0


def _check(method: str, action: str = "cap") -> None:
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}, use one of {METHODS}")
    if action not in ACTIONS:
        raise ValueError(f"unknown action {action!r}, use one of {ACTIONS}")


def _quantiles(method: str, target_col: str) -> Column:
    wanted = IQR_QUANTILES if method == "iqr" else TAIL_QUANTILES
    return F.percentile(target_col, F.array(*[F.lit(q) for q in wanted]))


def _bounds(quantiles: Column, method: str, multiplier: float) -> tuple[Column, Column]:
    low, high = quantiles[0], quantiles[1]
    if method == "iqr":
        reach = (high - low) * F.lit(float(multiplier))
        low, high = low - reach, high + reach
    return F.greatest(F.lit(0.0), low), high


def outlier_bounds(
    df: DataFrame,
    method: str = "iqr",
    iqr_multiplier: float = IQR_MULTIPLIER,
    series_cols: Sequence[str] = (),
    target_col: str = TARGET,
) -> DataFrame:
    """Lower bound (never below zero) and upper bound per series."""
    _check(method)
    stats = df.groupBy(*series_cols).agg(_quantiles(method, target_col).alias("_q"))
    low, high = _bounds(F.col("_q"), method, iqr_multiplier)
    return stats.select(*series_cols, low.alias("lower_bound"), high.alias("upper_bound"))


def _with_bounds(
    df: DataFrame, method: str, iqr_multiplier: float, series_cols: Sequence[str], target_col: str
) -> DataFrame:
    # A window rather than an aggregate joined back: it keeps the series partitioning that the
    # steps before and after use as well.
    w = whole(series_window(series_cols))
    with_q = df.withColumn("_q", _quantiles(method, target_col).over(w))
    low, high = _bounds(F.col("_q"), method, iqr_multiplier)
    return with_q.withColumns({"_low": low, "_high": high}).drop("_q")


def handle_outliers(
    df: DataFrame,
    method: str = "iqr",
    action: str = "cap",
    iqr_multiplier: float = IQR_MULTIPLIER,
    series_cols: Sequence[str] = (),
    target_col: str = TARGET,
) -> DataFrame:
    """Flag outlier days, cap them at the bound cut to a whole number, or remove them."""
    _check(method, action)
    bounded = _with_bounds(df, method, iqr_multiplier, series_cols, target_col)
    below = F.col(target_col) < F.col("_low")
    above = F.col(target_col) > F.col("_high")
    if action == "flag":
        result = bounded.withColumn("is_outlier", F.coalesce(below | above, F.lit(False)))
    elif action == "cap":
        capped = (
            F.when(below, F.col("_low").cast("bigint"))
            .when(above, F.col("_high").cast("bigint"))
            .otherwise(F.col(target_col))
        )
        result = bounded.withColumn(target_col, capped)
    else:
        result = bounded.where(~F.coalesce(below | above, F.lit(False)))
    return result.drop("_low", "_high")


def outlier_report(
    df: DataFrame,
    method: str = "iqr",
    iqr_multiplier: float = IQR_MULTIPLIER,
    series_cols: Sequence[str] = (),
    target_col: str = TARGET,
) -> DataFrame:
    """How many days lie below and above the bounds, and their share in percent."""
    _check(method)
    bounded = _with_bounds(df, method, iqr_multiplier, series_cols, target_col)
    below = F.count_if(F.col(target_col) < F.col("_low"))
    above = F.count_if(F.col(target_col) > F.col("_high"))
    return bounded.groupBy(*series_cols).agg(
        F.first("_low").alias("lower_bound"),
        F.first("_high").alias("upper_bound"),
        below.alias("n_below"),
        above.alias("n_above"),
        ((below + above) * 100.0 / F.count("*")).alias("outlier_pct"),
    )


def top_outliers(
    df: DataFrame,
    n: int = 3,
    method: str = "iqr",
    iqr_multiplier: float = IQR_MULTIPLIER,
    series_cols: Sequence[str] = (),
    target_col: str = TARGET,
) -> DataFrame:
    """The n highest and n lowest outlier days of each series; equal counts in date order."""
    _check(method)
    bounded = _with_bounds(df, method, iqr_multiplier, series_cols, target_col)
    count = F.col(target_col)
    side = F.when(count > F.col("_high"), "high").when(count < F.col("_low"), "low")
    extremes = bounded.withColumn("side", side).where(F.col("side").isNotNull())
    outward = F.when(F.col("side") == "high", -count).otherwise(count)
    w = Window.partitionBy(*series_cols, "side").orderBy(outward, DATE)
    return (
        extremes.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= n)
        .select(*series_cols, "side", "rank", DATE, target_col)
    )
