"""Features of daily series: calendar, waves, lags, rolling statistics, changes, future rows.

All window expressions of a series share one partitioning and one order, so Spark plans one
exchange and one sort for lags and rolling statistics together.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions import calendar as cal
from daymark.operators.gaps import gap_fill
from daymark.operators.weather import forecast_at_horizon, weather_at_target
from daymark.schema import (
    DATE,
    HORIZON,
    HORIZONS,
    LABEL,
    SPLIT,
    TARGET,
    WEATHER,
    require_columns,
    series_window,
    whole,
)

# Lags in rows, rolling windows in rows.
LAGS = (1, 2, 3, 7, 14, 21, 28)
ROLLING_WINDOWS = (3, 14, 30)


def lag_prefix(target_col: str = TARGET) -> str:
    return target_col.lower().replace("_per_day", "")


def add_date_parts(df: DataFrame) -> DataFrame:
    return df.withColumns(cal.date_parts(F.col(DATE)))


def add_cyclic_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns(cal.cyclic(F.col(DATE)))


def add_onehot_weekday(df: DataFrame) -> DataFrame:
    return df.withColumns(cal.onehot_weekday(F.col(DATE)))


def add_date_features(df: DataFrame) -> DataFrame:
    """Cyclic encodings and weekday indicators of the row date."""
    require_columns(df, [DATE])
    return add_onehot_weekday(add_cyclic_calendar(df))


def add_weekend(df: DataFrame) -> DataFrame:
    return df.withColumn("Weekend", cal.weekend(F.col(DATE)))


def weekend_share(df: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """Weekend days and their share in percent."""
    flag = cal.weekend(F.col(DATE))
    return df.groupBy(*series_cols).agg(
        F.sum(flag).alias("n_weekend_days"),
        F.count("*").alias("n_days"),
        (100 * F.avg(flag)).alias("weekend_pct"),
    )


def calendar_at_target(df: DataFrame, horizon: int | str) -> DataFrame:
    """Calendar features of the day `horizon` days after the row date."""
    ahead = F.col(horizon).cast("int") if isinstance(horizon, str) else F.lit(int(horizon))
    return df.withColumns(cal.calendar_features(F.date_add(DATE, ahead)))


def add_fourier(
    df: DataFrame,
    periods: Sequence[float] | None = None,
    harmonics: Mapping[float, int] | None = None,
    series_cols: Sequence[str] = (),
    anchor: dt.date | None = None,
) -> DataFrame:
    """Seasonal waves counted from `anchor`, by default the first day of each series."""
    start = F.lit(anchor) if anchor else F.min(DATE).over(whole(series_window(series_cols)))
    days = df.withColumn("_t", F.datediff(DATE, start))
    return days.withColumns(cal.fourier(F.col("_t"), periods, harmonics)).drop("_t")


def add_lags(
    df: DataFrame,
    lags: Sequence[int] = LAGS,
    target_col: str = TARGET,
    series_cols: Sequence[str] = (),
) -> DataFrame:
    """The count `k` rows earlier for every lag k."""
    require_columns(df, [target_col], "daily series")
    w = series_window(series_cols)
    columns = {f"{lag_prefix(target_col)}_lag_{k}": F.lag(target_col, k).over(w) for k in lags}
    weekly = f"{target_col}_7d_avg"
    if weekly in df.columns:
        columns["patients_7d_avg_lag_7"] = F.lag(weekly, 7).over(w)
    return df.withColumns(columns)


def add_rolling(
    df: DataFrame,
    windows: Sequence[int] = ROLLING_WINDOWS,
    target_col: str = TARGET,
    series_cols: Sequence[str] = (),
    mean: bool = True,
    std: bool = True,
) -> DataFrame:
    """Mean and sample deviation of the n rows before the row (the row itself is left out)."""
    require_columns(df, [target_col], "daily series")
    w = series_window(series_cols)
    columns: dict[str, Column] = {}
    for n in windows:
        before = w.rowsBetween(-n, -1)
        if mean:
            columns[f"patients_{n}d_avg"] = F.avg(target_col).over(before)
        if std:
            columns[f"patients_{n}d_std"] = F.stddev_samp(target_col).over(before)
    return df.withColumns(columns)


def add_changes(df: DataFrame, target_col: str = TARGET) -> DataFrame:
    """Day-over-day and week-over-week change, where the lags exist."""
    prefix = lag_prefix(target_col)
    pairs = {"patients_change_1d": (1, 2), "patients_change_7d": (7, 14)}
    columns = {}
    for name, (near, far) in pairs.items():
        newer, older = f"{prefix}_lag_{near}", f"{prefix}_lag_{far}"
        if newer in df.columns and older in df.columns:
            columns[name] = F.col(newer) - F.col(older)
    return df.withColumns(columns) if columns else df


def _row_features(
    df: DataFrame,
    include_fourier: bool,
    include_lags: bool,
    include_rolling: bool,
    include_changes: bool,
    series_cols: Sequence[str],
    target_col: str,
) -> DataFrame:
    if include_rolling:
        df = add_rolling(df, target_col=target_col, series_cols=series_cols)
    if include_fourier:
        df = add_fourier(df, series_cols=series_cols)
    if include_lags:
        df = add_lags(df, target_col=target_col, series_cols=series_cols)
        if include_changes:
            df = add_changes(df, target_col)
    return df


def engineer_features(
    df: DataFrame,
    include_date: bool = True,
    include_weekend: bool = True,
    include_fourier: bool = False,
    include_lags: bool = True,
    include_rolling: bool = True,
    include_changes: bool = True,
    series_cols: Sequence[str] = (),
    target_col: str = TARGET,
    strict_calendar: bool = False,
) -> DataFrame:
    """All features of the row date. `strict_calendar` completes the calendar first, so that a
    lag of k rows is a lag of k days."""
    if strict_calendar:
        df = gap_fill(df, series_cols, target_col)
    if include_date:
        df = add_date_features(df)
    if include_weekend:
        df = add_weekend(df)
    return _row_features(
        df, include_fourier, include_lags, include_rolling, include_changes, series_cols, target_col
    )


def engineer_for_horizons(
    df: DataFrame,
    weather: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    include_fourier: bool = False,
    include_lags: bool = True,
    include_rolling: bool = True,
    include_changes: bool = True,
    series_cols: Sequence[str] = (),
    location_cols: Sequence[str] = (),
    target_col: str = TARGET,
    include_lag0: bool = False,
) -> DataFrame:
    """Training features for all horizons in one table with a `horizon` column.

    Lags and rolling statistics belong to the row date and are computed once; each row is then
    spread over the horizons, and calendar and weather come from the target day.
    """
    base = _row_features(
        df.drop(*WEATHER),
        include_fourier,
        include_lags,
        include_rolling,
        include_changes,
        series_cols,
        target_col,
    )
    if include_lag0:
        base = base.withColumn(f"{lag_prefix(target_col)}_lag_0", F.col(target_col))
    ahead = F.explode(F.array(*[F.lit(int(h)) for h in horizons]))
    spread = calendar_at_target(base.withColumn(HORIZON, ahead), HORIZON)
    return weather_at_target(spread, weather, HORIZON, location_cols)


def last_known_row(df: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """The newest row of each series (an aggregation that combines map-side)."""
    rest = [c for c in df.columns if c not in series_cols]
    newest = df.groupBy(*series_cols).agg(F.max_by(F.struct(*rest), DATE).alias("_last"))
    return newest.select(
        *[c if c in series_cols else F.col(f"_last.{c}").alias(c) for c in df.columns]
    )


def horizon_expand(
    features: DataFrame,
    base_date: dt.date | None = None,
    series_cols: Sequence[str] = (),
    horizons: Sequence[int] = HORIZONS,
) -> DataFrame:
    """The newest feature row of each series, once per future day after the base date.

    The base date is the last day of the series unless given; `Date` becomes the future day.
    """
    newest = last_known_row(features, series_cols)
    base = F.lit(base_date) if base_date else F.col(DATE)
    ahead = F.explode(F.array(*[F.lit(int(h)) for h in horizons]))
    spread = newest.withColumn(HORIZON, ahead)
    return spread.withColumn(DATE, F.date_add(base, F.col(HORIZON)))


def calendar_at_horizon(future: DataFrame) -> DataFrame:
    """Calendar features of each future day; weekday indicators only where the table has them."""
    features = cal.calendar_features(F.col(DATE))
    has_onehot = any(c in future.columns for c in cal.ONEHOT_NAMES)
    kept = {
        name: column
        for name, column in features.items()
        if name not in cal.ONEHOT_NAMES or (has_onehot and name in future.columns)
    }
    return future.withColumns(kept)


def future_features(
    features: DataFrame,
    base_date: dt.date | None = None,
    forecast: DataFrame | None = None,
    series_cols: Sequence[str] = (),
    location_cols: Sequence[str] = (),
) -> DataFrame:
    """Feature rows for the coming week: newest state, calendar of the day, forecast weather."""
    future = calendar_at_horizon(horizon_expand(features, base_date, series_cols))
    if forecast is not None:
        future = forecast_at_horizon(future, forecast, location_cols)
    return future


def select_features(
    df: DataFrame, series_cols: Sequence[str] = (), target_col: str = TARGET
) -> list[str]:
    """Names of the model inputs: every column but keys, date, count, label and split."""
    excluded = {DATE, target_col, LABEL, HORIZON, SPLIT, *series_cols}
    return [c for c in df.columns if c not in excluded]
