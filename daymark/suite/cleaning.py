"""Queries for cleaning: duplicates, counting, gaps, outliers, and the composite plans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daymark.operators import clean, gaps, outliers
from daymark.plans.preprocess import preprocess, preprocess_cached
from daymark.schema import TARGET
from daymark.suite import inputs as i
from daymark.suite.catalog import query, rounded, rounded_sql, with_ctes

S = i.SERIES
AS_OF = dt.date(2001, 6, 1)


@query("dedup_visits", with_ctes(i.VISITS, i.ONCE) + " SELECT * FROM once")
def dedup_visits(spark, sf):
    slim = i.visits(spark, sf).select("series", "Surrogate_Key", "Contact_Start")
    return clean.dedup_visits(slim, series_cols=S)


@query(
    "dedup_visits_first",
    with_ctes(i.VISITS)
    + """ SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY series, Surrogate_Key, Contact_Start
                                   ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM visits) WHERE rn = 1""",
)
def dedup_visits_first(spark, sf):
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    return clean.dedup_visits(i.visits(spark, sf), series_cols=S, ingest_order=order)


@query(
    "duplicate_profile",
    rounded_sql(
        with_ctes(i.VISITS)
        + """ SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n) - count(*) AS BIGINT) AS n_duplicates,
                100.0::DOUBLE * CAST(sum(n) - count(*) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS duplicate_pct
         FROM (SELECT count(*) AS n FROM visits GROUP BY Surrogate_Key, Contact_Start)""",
        ["duplicate_pct"],
    ),
)
def duplicate_profile(spark, sf):
    return rounded(clean.duplicate_profile(i.visits(spark, sf)))


@query("daily_counts", with_ctes(i.DAILY) + " SELECT * FROM daily")
def daily_counts(spark, sf):
    return i.daily(spark, sf)


@query(
    "daily_counts_single",
    """SELECT CAST(ts AS DATE) AS "Date", CAST(count(*) AS BIGINT) AS Patients_per_day FROM events GROUP BY 1""",
)
def daily_counts_single(spark, sf):
    return clean.daily_counts(i.table(spark, sf, "events"), time_col="ts")


@query(
    "daily_counts_as_of",
    with_ctes(i.DAILY) + """ SELECT * FROM daily WHERE "Date" < DATE '2001-06-01'""",
)
def daily_counts_as_of(spark, sf):
    return clean.daily_counts(i.order_visits(spark, sf), S, as_of=AS_OF)


@query(
    "filter_incomplete_day",
    with_ctes(i.DAILY) + """ SELECT * FROM daily WHERE "Date" < DATE '2001-06-01'""",
)
def filter_incomplete_day(spark, sf):
    return clean.filter_incomplete_day(i.daily(spark, sf), AS_OF)


@query(
    "filter_zero_days",
    with_ctes(i.DAILY)
    + """ SELECT series, "Date", Patients_per_day - 1 AS Patients_per_day FROM daily WHERE Patients_per_day - 1 > 0""",
)
def filter_zero_days(spark, sf):
    return clean.filter_zero_days(i.daily(spark, sf).withColumn(TARGET, F.col(TARGET) - 1))


@query(
    "series_profile",
    rounded_sql(
        with_ctes(i.DAILY)
        + """ SELECT series, CAST(count(*) AS BIGINT) AS n_days, min("Date") AS first_date, max("Date") AS last_date,
                avg(Patients_per_day) AS mean_count, min(Patients_per_day) AS min_count,
                max(Patients_per_day) AS max_count FROM daily GROUP BY series""",
        ["mean_count"],
    ),
)
def series_profile(spark, sf):
    return rounded(clean.series_profile(i.daily(spark, sf), S))


@query("sort_by_date", with_ctes(i.DAILY) + ' SELECT * FROM daily ORDER BY series, "Date"')
def sort_by_date(spark, sf):
    return clean.sort_by_date(i.daily(spark, sf), S)


@query(
    "drop_null_rows",
    with_ctes(i.WEATHER_SQL, i.DAILY)
    + """ SELECT daily.*, weather.Temp_Max, weather.Precipitation
        FROM daily JOIN weather ON daily."Date" = weather."Date" """,
)
def drop_null_rows(spark, sf):
    weather = i.weather(spark, sf).select("Date", "Temp_Max", "Precipitation")
    merged = i.daily(spark, sf).join(weather, "Date", "left")
    return clean.drop_null_rows(merged)


@query(
    "null_profile",
    with_ctes(i.WEATHER_SQL, i.DAILY)
    + """, merged AS (SELECT daily.*, weather.Temp_Max AS Temp_Max FROM daily LEFT JOIN weather ON daily."Date" = weather."Date")
    SELECT c.column_name, CASE WHEN c.column_name = 'Temp_Max' THEN t.n_null ELSE CAST(0 AS BIGINT) END AS n_missing,
           t.n_null AS rows_affected, t.n AS n_rows
    FROM (SELECT unnest(['Date', 'series', 'Patients_per_day', 'Temp_Max']) AS column_name) c,
         (SELECT CAST(count(*) - count(Temp_Max) AS BIGINT) AS n_null, CAST(count(*) AS BIGINT) AS n FROM merged) t""",
)
def null_profile(spark, sf):
    merged = i.daily(spark, sf).join(i.weather(spark, sf).select("Date", "Temp_Max"), "Date", "left")
    return clean.null_profile(merged)


_ABSENT = """ SELECT days.series, days."Date" FROM days
  ANTI JOIN daily ON daily.series = days.series AND daily."Date" = days."Date" """


@query("missing_dates", with_ctes(i.DAILY, i.FILLED) + _ABSENT)
def missing_dates(spark, sf):
    return gaps.missing_dates(i.daily(spark, sf), S)


@query("calendar_except", with_ctes(i.DAILY, i.FILLED) + _ABSENT)
def calendar_except(spark, sf):
    return gaps.calendar_except(i.daily(spark, sf), S)


@query("head_missing", with_ctes(i.DAILY, i.FILLED) + _ABSENT + ' ORDER BY "Date", series LIMIT 5')
def head_missing(spark, sf):
    return gaps.head_missing(i.daily(spark, sf), S)


@query(
    "gap_profile",
    rounded_sql(
        with_ctes(i.DAILY)
        + """ SELECT series, CAST(max("Date") - min("Date") + 1 AS BIGINT) AS n_calendar_days,
                CAST(max("Date") - min("Date") + 1 - count(*) AS BIGINT) AS n_missing,
                CAST(100 AS DOUBLE) * (max("Date") - min("Date") + 1 - count(*)) / (max("Date") - min("Date") + 1) AS missing_pct
         FROM daily GROUP BY series""",
        ["missing_pct"],
    ),
)
def gap_profile(spark, sf):
    return rounded(gaps.gap_profile(i.daily(spark, sf), S))


@query(
    "weekday_median",
    with_ctes(i.DAILY)
    + """ SELECT series, CAST(isodow("Date") - 1 AS INTEGER) AS weekday,
            quantile_cont(Patients_per_day, 0.5) AS median_count FROM daily GROUP BY 1, 2
         UNION ALL SELECT series, NULL, quantile_cont(Patients_per_day, 0.5) FROM daily GROUP BY 1""",
)
def weekday_median(spark, sf):
    return gaps.weekday_median(i.daily(spark, sf), S)


@query("gap_fill", with_ctes(i.DAILY, i.FILLED) + " SELECT * FROM filled")
def gap_fill(spark, sf):
    return i.filled(spark, sf)


def _bounds_sql(low: float, high: float, reach: float) -> str:
    return f"""q AS (SELECT series, quantile_cont(Patients_per_day, {low}) AS a, quantile_cont(Patients_per_day, {high}) AS b
      FROM daily GROUP BY series),
    bounds AS (SELECT series, greatest(0.0, a - CAST({reach} AS DOUBLE) * (b - a)) AS lower_bound,
      b + CAST({reach} AS DOUBLE) * (b - a) AS upper_bound FROM q)"""


# A narrow reach makes outliers occur at every scale of the tables.
REACH = 0.25
IQR_SQL = with_ctes(i.DAILY, _bounds_sql(0.25, 0.75, REACH))
PCT_SQL = with_ctes(i.DAILY, _bounds_sql(0.01, 0.99, 0.0))


@query(
    "outlier_bounds_iqr",
    rounded_sql(
        with_ctes(i.DAILY, _bounds_sql(0.25, 0.75, 2.0)) + " SELECT * FROM bounds", ["lower_bound", "upper_bound"]
    ),
)
def outlier_bounds_iqr(spark, sf):
    return rounded(outliers.outlier_bounds(i.daily(spark, sf), series_cols=S))


@query(
    "outlier_bounds_pct",
    rounded_sql(PCT_SQL + " SELECT * FROM bounds", ["lower_bound", "upper_bound"]),
)
def outlier_bounds_pct(spark, sf):
    return rounded(outliers.outlier_bounds(i.daily(spark, sf), "percentile", series_cols=S))


@query(
    "outlier_flag",
    IQR_SQL
    + """ SELECT daily.*, Patients_per_day < lower_bound OR Patients_per_day > upper_bound AS is_outlier
        FROM daily JOIN bounds USING (series)""",
)
def outlier_flag(spark, sf):
    return outliers.handle_outliers(i.daily(spark, sf), "iqr", "flag", REACH, S)


@query(
    "outlier_cap",
    IQR_SQL
    + """ SELECT daily.series, daily."Date",
           CAST(CASE WHEN Patients_per_day < lower_bound THEN trunc(lower_bound)
                     WHEN Patients_per_day > upper_bound THEN trunc(upper_bound)
                     ELSE Patients_per_day END AS BIGINT) AS Patients_per_day
        FROM daily JOIN bounds USING (series)""",
)
def outlier_cap(spark, sf):
    return outliers.handle_outliers(i.daily(spark, sf), "iqr", "cap", REACH, S)


@query(
    "outlier_remove",
    PCT_SQL
    + """ SELECT daily.* FROM daily JOIN bounds USING (series)
        WHERE NOT (Patients_per_day < lower_bound OR Patients_per_day > upper_bound)""",
)
def outlier_remove(spark, sf):
    return outliers.handle_outliers(i.daily(spark, sf), "percentile", "remove", series_cols=S)


@query(
    "outlier_report",
    rounded_sql(
        IQR_SQL
        + """ SELECT series, any_value(lower_bound) AS lower_bound, any_value(upper_bound) AS upper_bound,
            CAST(count(*) FILTER (Patients_per_day < lower_bound) AS BIGINT) AS n_below,
            CAST(count(*) FILTER (Patients_per_day > upper_bound) AS BIGINT) AS n_above,
            CAST(100 AS DOUBLE) * count(*) FILTER (Patients_per_day < lower_bound OR Patients_per_day > upper_bound) / count(*) AS outlier_pct
          FROM daily JOIN bounds USING (series) GROUP BY series""",
        ["lower_bound", "upper_bound", "outlier_pct"],
    ),
)
def outlier_report(spark, sf):
    return rounded(outliers.outlier_report(i.daily(spark, sf), "iqr", REACH, S))


@query(
    "top_outliers",
    IQR_SQL
    + """, o AS (SELECT daily.*, CASE WHEN Patients_per_day > upper_bound THEN 'high'
                                    WHEN Patients_per_day < lower_bound THEN 'low' END AS side
               FROM daily JOIN bounds USING (series)),
      r AS (SELECT *, CAST(row_number() OVER (PARTITION BY series, side
              ORDER BY CASE WHEN side = 'high' THEN -Patients_per_day ELSE Patients_per_day END, "Date") AS INTEGER) AS rank
            FROM o WHERE side IS NOT NULL)
      SELECT series, side, rank, "Date", Patients_per_day FROM r WHERE rank <= 3""",
)
def top_outliers(spark, sf):
    return outliers.top_outliers(i.daily(spark, sf), 3, "iqr", REACH, S)


_DAILY_ONCE = """daily AS (SELECT series, CAST(Contact_Start AS DATE) AS "Date", CAST(count(*) AS BIGINT) AS Patients_per_day
  FROM once WHERE Contact_Start < TIMESTAMP '2001-06-01' GROUP BY 1, 2)"""


@query(
    "preprocess",
    with_ctes(i.VISITS, i.ONCE, _DAILY_ONCE, i.FILLED)
    + """, q AS (SELECT series, quantile_cont(Patients_per_day, 0.25) AS a, quantile_cont(Patients_per_day, 0.75) AS b
               FROM filled GROUP BY series),
      bounds AS (SELECT series, greatest(0.0, a - 2 * (b - a)) AS lo, b + 2 * (b - a) AS hi FROM q)
      SELECT filled.series, filled."Date",
             CAST(CASE WHEN Patients_per_day < lo THEN trunc(lo) WHEN Patients_per_day > hi THEN trunc(hi)
                       ELSE Patients_per_day END AS BIGINT) AS Patients_per_day
      FROM filled JOIN bounds USING (series)""",
)
def preprocess_query(spark, sf):
    return preprocess(i.visits(spark, sf), S, AS_OF)


@query(
    "preprocess_cached",
    with_ctes(i.VISITS, i.ONCE, _DAILY_ONCE, i.FILLED) + " SELECT * FROM filled WHERE Patients_per_day > 0",
)
def preprocess_cached_query(spark, sf):
    return preprocess_cached(i.visits(spark, sf), S, AS_OF)
