"""Queries for weather: payloads, joins, fills, and parsing of printed tuples."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daymark.functions.shape import zip_explode
from daymark.operators import fill, weather as ops
from daymark.operators import validate
from daymark.schema import WEATHER
from daymark.sources.visits import parse_tuple_dump
from daymark.sources.weather import (
    ARCHIVE_FIELDS,
    FORECAST_FIELDS,
    json_payload,
    scan_weather_archive,
    scan_weather_forecast,
    weather_request,
)
from daymark.suite import inputs as i
from daymark.suite.catalog import query, rounded, rounded_sql, with_ctes

S = i.SERIES

MERGED = """merged AS (SELECT filled.series, filled."Date", filled.Patients_per_day,
    weather.Temp_Max, weather.Temp_Min, weather.Temp_Mean, weather.Precipitation, weather.Snowfall
  FROM filled LEFT JOIN weather ON filled."Date" = weather."Date")"""
BASE = with_ctes(i.DAILY, i.FILLED, i.WEATHER_SQL, MERGED)


def last_known_sql(source: str, keep: str, keys: str, columns=WEATHER) -> str:
    filled = ",\n".join(
        f"""coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY "Date" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            first_value({c} IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY "Date" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS {c}"""
        for c in columns
    )
    return f"SELECT {keep}, {filled} FROM {source}"


def linear_sql(source: str, keep: str, keys: str, columns=WEATHER) -> str:
    before = "OVER (PARTITION BY {k} ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)".format(k=keys)
    after = "OVER (PARTITION BY {k} ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)".format(k=keys)
    neighbours = ",\n".join(
        f"""last_value({c} IGNORE NULLS) {before} AS pv_{c}, first_value({c} IGNORE NULLS) {after} AS nv_{c},
            last_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) {before} AS pr_{c},
            first_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) {after} AS nr_{c}"""
        for c in columns
    )
    values = ",\n".join(
        f"""coalesce({c}, pv_{c} + (nv_{c} - pv_{c}) * (CAST(rn - pr_{c} AS DOUBLE) / nullif(nr_{c} - pr_{c}, 0)), pv_{c}, nv_{c}, 0) AS {c}"""
        for c in columns
    )
    return f"""SELECT {keep}, {values} FROM (SELECT *, {neighbours} FROM
      (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY "Date") AS rn FROM {source}))"""


def _merge(spark, sf, fallback):
    merged = ops.merge_weather(i.filled(spark, sf), i.weather(spark, sf), fallback, S, validate=False)
    return rounded(merged)


KEEP = 'series, "Date", Patients_per_day'


@query("merge_weather", rounded_sql(BASE + " " + last_known_sql("merged", KEEP, "series"), WEATHER))
def merge_weather(spark, sf):
    return _merge(spark, sf, "last_known")


@query("weather_fallback_last", rounded_sql(BASE + " " + last_known_sql("merged", KEEP, "series"), WEATHER))
def weather_fallback_last(spark, sf):
    joined = i.filled(spark, sf).join(i.weather(spark, sf), "Date", "left")
    return rounded(fill.fill_last_known(joined, WEATHER, S))


@query("weather_fallback_interp", rounded_sql(BASE + " " + linear_sql("merged", KEEP, "series"), WEATHER))
def weather_fallback_interp(spark, sf):
    return _merge(spark, sf, "interpolate")


@query(
    "weather_fallback_zero",
    rounded_sql(
        BASE + f" SELECT {KEEP}, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in WEATHER) + " FROM merged", WEATHER
    ),
)
def weather_fallback_zero(spark, sf):
    return _merge(spark, sf, "zero")


# Fills of one long series: the weather table on its own full calendar.
CALENDAR_WEATHER = """span AS (SELECT min("Date") - 3 AS d0, max("Date") + 3 AS d1 FROM weather),
 cal AS (SELECT CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS "Date" FROM span),
 holed AS (SELECT 0 AS one, cal."Date", Temp_Max, Temp_Min, Temp_Mean, Precipitation, Snowfall
           FROM cal LEFT JOIN weather ON cal."Date" = weather."Date")"""


def _holed(spark, sf):
    w = i.weather(spark, sf)
    span = w.agg(F.date_sub(F.min("Date"), 3).alias("a"), F.date_add(F.max("Date"), 3).alias("b"))
    days = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("Date"))
    return days.join(w, "Date", "left")


@query(
    "fill_last_known",
    rounded_sql(with_ctes(i.WEATHER_SQL, CALENDAR_WEATHER) + " " + last_known_sql("holed", '"Date"', "one"), WEATHER),
)
def fill_last_known(spark, sf):
    return rounded(fill.fill_last_known(_holed(spark, sf), WEATHER))


@query(
    "fill_linear",
    rounded_sql(with_ctes(i.WEATHER_SQL, CALENDAR_WEATHER) + " " + linear_sql("holed", '"Date"', "one"), WEATHER),
)
def fill_linear(spark, sf):
    return rounded(fill.fill_linear(_holed(spark, sf), WEATHER))


@query(
    "weather_profile",
    rounded_sql(
        with_ctes(i.WEATHER_OF_ALL_DAYS_SQL)
        + """ SELECT min(Temp_Mean) AS min_temp, max(Temp_Mean) AS max_temp, avg(Temp_Mean) AS mean_temp,
                sum(Precipitation) AS total_precipitation FROM weather""",
        ["min_temp", "max_temp", "mean_temp", "total_precipitation"],
    ),
)
def weather_profile(spark, sf):
    return rounded(ops.weather_profile(i.weather_of_all_days(spark, sf)))


@query(
    "weather_at_target",
    rounded_sql(
        with_ctes(i.DAILY, i.WEATHER_SQL)
        + """ SELECT daily.*, Temp_Max, Temp_Min, Temp_Mean, Precipitation, Snowfall
            FROM daily LEFT JOIN weather ON daily."Date" + 3 = weather."Date" """,
        WEATHER,
    ),
)
def weather_at_target(spark, sf):
    return rounded(ops.weather_at_target(i.daily(spark, sf), i.weather(spark, sf), 3))


@query(
    "weather_request",
    rounded_sql(
        with_ctes(i.PAYLOAD_DAYS)
        + """ SELECT * FROM numbers WHERE "Date" BETWEEN DATE '1996-02-01' AND DATE '1999-06-30' AND location = 'R'""",
        WEATHER,
    ),
)
def request(spark, sf):
    items = i.table(spark, sf, "lineitem").withColumn("Date", F.to_date("l_shipdate"))
    disc, tax = F.round(F.col("l_discount") * 100).cast("int"), F.round(F.col("l_tax") * 100).cast("int")
    landed = items.groupBy(F.col("l_returnflag").alias("location"), "Date").agg(
        F.max(disc).cast("double").alias("Temp_Max"),
        F.min(disc).cast("double").alias("Temp_Min"),
        F.avg(disc).alias("Temp_Mean"),
        F.sum("l_quantity").alias("Precipitation"),
        F.avg(tax).alias("Snowfall"),
    )
    window = dt.date(1996, 2, 1), dt.date(1999, 6, 30)
    return rounded(weather_request(landed, *window, {"location": "R"}))


@query(
    "scan_weather_archive",
    rounded_sql(
        with_ctes(i.PAYLOAD_DAYS) + " " + last_known_sql("payload", 'location, "Date"', "location"), WEATHER
    ),
)
def archive(spark, sf):
    parsed = json_payload(i.payloads(spark, sf), "payload", ARCHIVE_FIELDS)
    return rounded(scan_weather_archive(parsed, ["location"]))


_MEAN = """, means AS (SELECT location, "Date", Temp_Max, Temp_Min, (Temp_Max + Temp_Min) / 2 AS Temp_Mean,
   Precipitation, Snowfall FROM payload)"""


@query(
    "scan_weather_forecast",
    rounded_sql(
        with_ctes(i.PAYLOAD_DAYS) + _MEAN + " " + last_known_sql("means", 'location, "Date"', "location"), WEATHER
    ),
)
def forecast(spark, sf):
    parsed = json_payload(i.payloads(spark, sf), "payload", FORECAST_FIELDS)
    return rounded(scan_weather_forecast(parsed, ["location"]))


@query(
    "json_payload",
    with_ctes(i.PAYLOAD_DAYS)
    + """ SELECT location, CAST(min("Date") AS VARCHAR) AS first_day, CAST(count(*) AS INTEGER) AS n_days,
             CAST(count(*) - count(Temp_Max) AS INTEGER) AS n_null
        FROM payload GROUP BY location, date_trunc('month', "Date")""",
)
def payload_shape(spark, sf):
    parsed = json_payload(i.payloads(spark, sf), "payload")
    return parsed.select(
        "location",
        F.col("daily.time")[0].alias("first_day"),
        F.size("daily.time").alias("n_days"),
        F.size(F.filter("daily.temperature_2m_max", lambda x: x.isNull())).alias("n_null"),
    )


@query(
    "zip_explode",
    rounded_sql(
        with_ctes(i.PAYLOAD_DAYS)
        + ' SELECT location, CAST("Date" AS VARCHAR) AS day, Temp_Max AS high, Precipitation AS rain FROM payload',
        ["high", "rain"],
    ),
)
def arrays_to_rows(spark, sf):
    parsed = json_payload(i.payloads(spark, sf), "payload")
    arrays = {
        "day": F.col("daily.time"),
        "high": F.col("daily.temperature_2m_max"),
        "rain": F.col("daily.precipitation_sum"),
    }
    return rounded(zip_explode(parsed, arrays, ["location"]))


@query(
    "parse_tuple_dump",
    """SELECT CAST(event_id AS VARCHAR) AS Surrogate_Key,
          CASE WHEN event_id % 10 = 3 THEN date_trunc('second', ts) ELSE ts END AS Contact_Start
       FROM events WHERE event_id % 10 NOT IN (0, 1, 2, 4)""",
)
def tuples(spark, sf):
    return parse_tuple_dump(i.tuple_lines(spark, sf))


@query(
    "validate_overlap",
    with_ctes(i.DAILY, i.WEATHER_SQL)
    + """ SELECT a.lo AS left_first, a.hi AS left_last, b.lo AS right_first, b.hi AS right_last,
             a.lo <= b.hi AND a.hi >= b.lo AS overlaps
        FROM (SELECT min("Date") AS lo, max("Date") AS hi FROM daily) a,
             (SELECT min("Date") AS lo, max("Date") AS hi FROM weather) b""",
)
def validate_overlap(spark, sf):
    return validate.overlap(i.daily(spark, sf), i.weather(spark, sf))
