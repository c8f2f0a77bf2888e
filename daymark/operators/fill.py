"""Filling missing values along the date order of a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daymark.schema import DATE, series_window


def _running(series_cols: Sequence[str], order: Column) -> WindowSpec:
    """Rows up to this one in the given order.

    Looking ahead is looking back in reverse order: one more sort per series, while a frame that
    reaches to the end of the partition is evaluated from every row again.
    """
    return series_window(series_cols, [order]).rowsBetween(Window.unboundedPreceding, 0)


def _known(column: str) -> Column:
    """The value, or NULL where it is missing in either form."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def fill_last_known(
    df: DataFrame, cols: Sequence[str], series_cols: Sequence[str] = (), order: str = DATE
) -> DataFrame:
    """Last earlier value, else first later value, else 0."""
    back = _running(series_cols, F.col(order))
    ahead = _running(series_cols, F.col(order).desc())
    earlier = {f"_p_{c}": F.last(_known(c), True).over(back) for c in cols}
    later = {f"_n_{c}": F.last(_known(c), True).over(ahead) for c in cols}
    filled = {c: F.coalesce(f"_p_{c}", f"_n_{c}", F.lit(0.0)) for c in cols}
    return df.withColumns({**earlier, **later}).withColumns(filled).drop(*earlier, *later)


def fill_linear(
    df: DataFrame, cols: Sequence[str], series_cols: Sequence[str] = (), order: str = DATE
) -> DataFrame:
    """Straight line between the neighbours by row position; ends take the nearest value; else 0."""
    back = _running(series_cols, F.col(order))
    ahead = _running(series_cols, F.col(order).desc())
    placed = df.withColumn("_row", F.row_number().over(series_window(series_cols, order)))
    earlier: dict[str, Column] = {}
    later: dict[str, Column] = {}
    for c in cols:
        here = F.when(_known(c).isNotNull(), F.struct(_known(c).alias("v"), F.col("_row").alias("r")))
        earlier[f"_p_{c}"] = F.last(here, True).over(back)
        later[f"_n_{c}"] = F.last(here, True).over(ahead)
    placed = placed.withColumns({**earlier, **later})
    filled = {}
    for c in cols:
        before, after = F.col(f"_p_{c}"), F.col(f"_n_{c}")
        share = F.try_divide(F.col("_row") - before.r, after.r - before.r)
        between = before.v + (after.v - before.v) * share
        filled[c] = F.coalesce(_known(c), between, before.v, after.v, F.lit(0.0))
    return placed.withColumns(filled).drop("_row", *earlier, *later)


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(_known(c), F.lit(0.0)) for c in cols})
