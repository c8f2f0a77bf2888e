"""Joining a daily exogenous (weather) table to daily series.

Joins carry no broadcast hints: Spark broadcasts the weather side when its size is below
`spark.sql.autoBroadcastJoinThreshold` (planned or measured at run time) and sorts and merges
otherwise, so a table with very many locations still works.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.operators.clean import first_per_key
from daymark.operators.fill import fill_last_known, fill_linear, fill_zero
from daymark.operators.validate import require_overlap
from daymark.schema import DATE, WEATHER, require_columns

FALLBACKS = ("last_known", "interpolate", "zero", "error")


def merge_weather(
    daily: DataFrame,
    weather: DataFrame,
    fallback: str = "last_known",
    series_cols: Sequence[str] = (),
    location_cols: Sequence[str] = (),
    validate: bool = True,
) -> DataFrame:
    """Keep every series day, add its weather, then fill what is missing.

    `validate` runs the date-range check (an action) first; the `error` fallback counts
    missing rows (also an action) and raises.
    """
    if fallback not in FALLBACKS:
        raise ValueError(f"unknown fallback {fallback!r}, use one of {FALLBACKS}")
    require_columns(daily, [DATE, *series_cols, *location_cols], "daily series")
    require_columns(weather, [DATE, *location_cols], "weather")
    if validate:
        require_overlap(daily, weather)
    # Weather of a day that was delivered twice must not double the day.
    once = first_per_key(weather.select(*location_cols, DATE, *WEATHER), [*location_cols, DATE])
    merged = daily.join(once, [*location_cols, DATE], "left")
    merged = merged.select(*daily.columns, *WEATHER)
    if fallback == "last_known":
        return fill_last_known(merged, WEATHER, series_cols)
    if fallback == "interpolate":
        return fill_linear(merged, WEATHER, series_cols)
    if fallback == "zero":
        return fill_zero(merged, WEATHER)
    absent = merged.where(
        " OR ".join(f"{c} IS NULL" for c in WEATHER)
    ).count()
    if absent:
        raise ValueError(f"{absent} days lack weather")
    return merged


def weather_profile(weather: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Temperature range and mean, and total precipitation."""
    return weather.groupBy(*by).agg(
        F.min("Temp_Mean").alias("min_temp"),
        F.max("Temp_Mean").alias("max_temp"),
        F.avg("Temp_Mean").alias("mean_temp"),
        F.sum("Precipitation").alias("total_precipitation"),
    )


def weather_at_target(
    df: DataFrame,
    weather: DataFrame,
    horizon: int | str,
    location_cols: Sequence[str] = (),
) -> DataFrame:
    """Weather of the day `horizon` days ahead (a number or a column); absent days stay NULL."""
    ahead = F.col(horizon) if isinstance(horizon, str) else F.lit(int(horizon))
    present = [c for c in WEATHER if c in df.columns or c in weather.columns]
    base = df.drop(*present).withColumn("_target_day", F.date_add(DATE, ahead.cast("int")))
    once = first_per_key(weather.select(*location_cols, DATE, *present), [*location_cols, DATE])
    lookup = once.select(
        *[F.col(c).alias(f"_at_{c}") for c in location_cols],
        F.col(DATE).alias("_weather_day"),
        *present,
    )
    condition = base["_target_day"] == lookup["_weather_day"]
    for c in location_cols:
        condition = condition & (base[c] == lookup[f"_at_{c}"])
    keep = [c for c in df.columns if c not in present]
    return base.join(lookup, condition, "left").select(*keep, *present)


def forecast_at_horizon(
    future: DataFrame, forecast: DataFrame, location_cols: Sequence[str] = ()
) -> DataFrame:
    """Forecast weather of each future day where a forecast row exists, else the last known.

    A matching row wins even where one of its values is NULL.
    """
    present = [c for c in WEATHER if c in future.columns and c in forecast.columns]
    keys = [*location_cols, DATE]
    once = first_per_key(forecast.select(*keys, *present), keys)
    lookup = once.select(
        *[F.col(c).alias(f"_on_{c}") for c in keys],
        F.struct(*present).alias("_forecast"),
    )
    condition = F.lit(True)
    for c in keys:
        condition = condition & (future[c] == lookup[f"_on_{c}"])
    joined = future.join(lookup, condition, "left")
    matched = F.col("_forecast").isNotNull()
    return joined.select(
        *[
            F.when(matched, F.col(f"_forecast.{c}")).otherwise(F.col(c)).alias(c)
            if c in present
            else F.col(c)
            for c in future.columns
        ]
    )
