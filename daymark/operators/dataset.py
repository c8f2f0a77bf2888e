"""Labels and temporal splits for training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymark.operators.clean import drop_null_rows
from daymark.schema import DATE, HORIZON, HORIZONS, LABEL, SPLIT, TARGET, require_columns, series_window

# Shares of the four parts in time order.
SPLIT_RATIOS = {"train": 0.60, "val": 0.10, "calib": 0.10, "test": 0.20}


def shifted_target(
    df: DataFrame,
    horizon: int | None = None,
    target_col: str = TARGET,
    series_cols: Sequence[str] = (),
) -> DataFrame:
    """Label = the count `horizon` rows later; rows without a label are dropped.

    Without a number the table's own `horizon` column decides, row by row; each (series,
    horizon) is then its own sequence, and one window serves all horizons.
    """
    require_columns(df, [target_col], "feature table")
    if horizon is not None:
        if horizon not in HORIZONS:
            raise ValueError(f"horizon must be 1..7, got {horizon}")
        label = F.lead(target_col, horizon).over(series_window(series_cols))
    else:
        require_columns(df, [HORIZON], "feature table")
        w = series_window([*series_cols, HORIZON])
        label = F.lit(None)
        for h in HORIZONS:
            label = F.when(F.col(HORIZON) == h, F.lead(target_col, h).over(w)).otherwise(label)
    return df.withColumn(LABEL, label.cast("double")).dropna(subset=[LABEL])


def training_rows(
    features: DataFrame,
    series_cols: Sequence[str] = (),
    target_col: str = TARGET,
    lossless: bool = False,
) -> DataFrame:
    """Complete, labelled rows.

    By default rows with missing features go first and the label is taken from the rows that
    are left, so the newest days are lost twice. `lossless` labels first.
    """
    if lossless:
        return drop_null_rows(shifted_target(features, None, target_col, series_cols))
    return shifted_target(drop_null_rows(features), None, target_col, series_cols)


def temporal_split(
    df: DataFrame,
    ratios: dict[str, float] | None = None,
    series_cols: Sequence[str] = (),
) -> DataFrame:
    """Add `split`: the first part of each series trains, then validation, calibration, test."""
    ratios = ratios or SPLIT_RATIOS
    if abs(sum(ratios.values()) - 1.0) > 1e-8:
        raise ValueError(f"split ratios must sum to 1, got {sum(ratios.values())}")
    keys = [*series_cols, *([HORIZON] if HORIZON in df.columns else [])]
    w = series_window(keys)
    sized = df.withColumns(
        {
            "_row": F.row_number().over(w),
            "_n": F.count("*").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        }
    )
    *leading, last = ratios
    end = F.lit(0)
    part = None
    for name in leading:
        end = end + F.floor(F.lit(float(ratios[name])) * F.col("_n"))
        reached = F.col("_row") <= end
        part = F.when(reached, name) if part is None else part.when(reached, name)
    return sized.withColumn(SPLIT, part.otherwise(last)).drop("_row", "_n")


def split_sizes(df: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """Rows per part."""
    keys = [*series_cols, *([HORIZON] if HORIZON in df.columns else [])]
    return df.groupBy(*keys, SPLIT).agg(
        F.count("*").alias("n_rows"), F.min(DATE).alias("first_date"), F.max(DATE).alias("last_date")
    )
