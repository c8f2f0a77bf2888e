import datetime as dt
import json

import pytest

from daymark.operators import weather as ops
from daymark.schema import WEATHER
from daymark.sources import weather as src
from tests.conftest import values

KINDS = "Date date, " + ", ".join(f"{c} double" for c in WEATHER)


def weather(spark, *days):
    return spark.createDataFrame([(dt.date.fromisoformat(d), float(i + 1), 0.0, 0.5, 2.0, 0.0) for i, d in enumerate(days)], KINDS)


def test_merge_keeps_every_series_day(spark, daily):
    df, w = daily("2022-01-01", [1, 2, 3, 4, 5]), weather(spark, "2022-01-01", "2022-01-02", "2022-01-04")
    out = ops.merge_weather(df, w)
    assert values(out, "Temp_Max") == [1, 2, 2, 3, 3]
    assert values(ops.merge_weather(df, w, "interpolate"), "Temp_Max") == [1, 2, 2.5, 3, 3]
    assert values(ops.merge_weather(df, w, "zero"), "Temp_Max") == [1, 2, 0, 3, 0]


def test_merge_errors(spark, daily):
    df = daily("2022-01-01", [1, 2, 3])
    with pytest.raises(ValueError):
        ops.merge_weather(df, weather(spark, "2023-01-01"))
    with pytest.raises(ValueError):
        ops.merge_weather(df, weather(spark, "2022-01-01"), "error")
    with pytest.raises(ValueError):
        ops.merge_weather(df, weather(spark, "2022-01-01"), "guess")
    with pytest.raises(KeyError):
        ops.merge_weather(df.withColumnRenamed("Date", "day"), weather(spark, "2022-01-01"))
    full = weather(spark, "2022-01-01", "2022-01-02", "2022-01-03")
    assert ops.merge_weather(df, full, "error").count() == 3


def test_weather_by_location(spark, daily):
    from pyspark.sql import functions as F

    df = daily("2022-01-01", [1, 2], "a").union(daily("2022-01-01", [3, 4], "b"))
    w = weather(spark, "2022-01-01", "2022-01-02")
    w = w.withColumn("series", F.lit("a")).union(w.withColumn("Temp_Max", F.lit(9.0)).withColumn("series", F.lit("b")))
    out = ops.merge_weather(df, w, series_cols=["series"], location_cols=["series"])
    assert values(out.where("series = 'b'"), "Temp_Max") == [9, 9]


def payload(tmp_path, drop=(), **override):
    daily = {
        "time": ["2022-01-01", "2022-01-02"],
        "temperature_2m_max": [5.0, None],
        "temperature_2m_min": [-2.0, -1.0],
        "temperature_2m_mean": [1.5, None],
        "precipitation_sum": [0.0, 2.5],
        "snowfall_sum": [None, None],
        **override,
    }
    path = tmp_path / "payload.json"
    path.write_text(json.dumps({"daily": {k: v for k, v in daily.items() if k not in drop}}, indent=1))
    return str(path)


def test_archive_payload(spark, tmp_path):
    out = src.scan_weather_archive(src.read_payload(spark, payload(tmp_path)))
    assert out.columns == ["Date", *WEATHER]
    assert values(out, "Temp_Max") == [5.0, 5.0]
    assert values(out, "Temp_Mean") == [1.5, 1.5]
    assert values(out, "Snowfall") == [0.0, 0.0]


def test_forecast_mean_is_taken_before_filling(spark, tmp_path):
    read = src.read_payload(spark, payload(tmp_path), src.FORECAST_FIELDS)
    out = src.scan_weather_forecast(read)
    assert values(out, "Temp_Mean") == [1.5, 1.5]
    assert values(out, "Temp_Max") == [5.0, 5.0]


def test_payload_without_daily(spark, tmp_path):
    path = tmp_path / "bad.json"
    path.write_text('{"reason": "limit"}')
    with pytest.raises(ValueError):
        src.read_payload(spark, str(path))
    with pytest.raises(ValueError):
        src.scan_weather_archive(spark.createDataFrame([(1,)], "x int"))


def test_request_window(spark):
    w = weather(spark, "2022-01-01", "2022-01-02", "2022-01-03")
    out = src.weather_request(w, dt.date(2022, 1, 2), dt.date(2022, 1, 9))
    assert values(out, "Temp_Max") == [2.0, 3.0]
