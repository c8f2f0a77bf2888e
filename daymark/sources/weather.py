"""Daily weather from landed service payloads (one JSON record with parallel arrays)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.functions.shape import zip_explode
from daymark.operators.fill import fill_last_known
from daymark.schema import DATE, WEATHER, nan_to_null

# Array names in the payload and the columns they become.
ARCHIVE_FIELDS = {
    "temperature_2m_max": "Temp_Max",
    "temperature_2m_min": "Temp_Min",
    "temperature_2m_mean": "Temp_Mean",
    "precipitation_sum": "Precipitation",
    "snowfall_sum": "Snowfall",
}
FORECAST_FIELDS = {k: v for k, v in ARCHIVE_FIELDS.items() if v != "Temp_Mean"}


def payload_type(fields: Mapping[str, str] = ARCHIVE_FIELDS) -> T.StructType:
    numbers = [T.StructField(name, T.ArrayType(T.DoubleType())) for name in fields]
    daily = T.StructType([T.StructField("time", T.ArrayType(T.StringType())), *numbers])
    return T.StructType([T.StructField("daily", daily)])


def json_payload(df: DataFrame, column: str, fields: Mapping[str, str] = ARCHIVE_FIELDS) -> DataFrame:
    """Parse a text column with a payload into its nested record."""
    parsed = df.withColumn("_payload", F.from_json(column, payload_type(fields)))
    return parsed.withColumn("daily", F.col("_payload.daily")).drop("_payload", column)


def _require(df: DataFrame, names: Sequence[str]) -> None:
    kind = df.schema["daily"].dataType if "daily" in df.columns else None
    present = kind.fieldNames() if isinstance(kind, T.StructType) else []
    absent = [n for n in names if n not in present]
    if absent:
        raise ValueError(f"payload lacks {absent}")


def _rows(df: DataFrame, fields: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    _require(df, ["time", *fields])
    arrays = {DATE: F.col("daily.time")}
    arrays.update({column: F.col(f"daily.{name}") for name, column in fields.items()})
    rows = zip_explode(df, arrays, keep)
    return nan_to_null(rows.withColumn(DATE, F.to_date(DATE)))


def scan_weather_archive(payload: DataFrame, location_cols: Sequence[str] = ()) -> DataFrame:
    """Observed weather, one row per day, holes filled along the dates of a location."""
    rows = _rows(payload, ARCHIVE_FIELDS, location_cols)
    return fill_last_known(rows, WEATHER, location_cols).select(*location_cols, DATE, *WEATHER)


def scan_weather_forecast(payload: DataFrame, location_cols: Sequence[str] = ()) -> DataFrame:
    """Forecast weather; the mean temperature is halfway between the extremes, before filling."""
    rows = _rows(payload, FORECAST_FIELDS, location_cols)
    rows = rows.withColumn("Temp_Mean", (F.col("Temp_Max") + F.col("Temp_Min")) / 2)
    return fill_last_known(rows, WEATHER, location_cols).select(*location_cols, DATE, *WEATHER)


def read_payload(
    spark: SparkSession, path: str, fields: Mapping[str, str] = ARCHIVE_FIELDS
) -> DataFrame:
    """Landed payload files, one JSON document per file; a document without `daily` raises."""
    payload = spark.read.schema(payload_type(fields)).option("multiLine", True).json(path)
    if not payload.where(F.col("daily").isNull()).isEmpty():
        raise ValueError(f"payload without 'daily' in {path}")
    return payload


def weather_request(
    weather: DataFrame,
    start: dt.date | Column,
    end: dt.date | Column,
    location: Mapping[str, object] | None = None,
) -> DataFrame:
    """The days of a window at one location, from landed weather."""
    rows = weather.where(F.col(DATE).between(_day(start), _day(end)))
    for column, value in (location or {}).items():
        rows = rows.where(F.col(column) == value)
    return rows


def _day(value: dt.date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
