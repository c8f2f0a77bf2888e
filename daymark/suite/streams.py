"""Queries over streams and over a state that grows."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from daymark.operators.gaps import gap_fill
from daymark.operators.outliers import handle_outliers
from daymark.plans.incremental import merge_visits, read_daily
from daymark.session import shared_folder
from daymark.streaming.daily import streaming_daily_counts, write_closed_days
from daymark.suite import inputs as i
from daymark.suite.catalog import ORACLES, query
from daymark.suite.cleaning import AS_OF

S = i.SERIES


def _path(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "streaming_daily_counts",
    """SELECT event_type AS series, CAST(ts AS DATE) AS "Date", CAST(count(*) AS BIGINT) AS Patients_per_day
      FROM (SELECT DISTINCT event_type, event_id, ts FROM events)
      WHERE CAST(ts AS DATE) + INTERVAL 2 DAY <= (SELECT max(ts) FROM events) GROUP BY 1, 2""",
)
def streaming_daily(spark, sf):
    """Closed days of the events table, read as a stream."""
    kinds = i.table(spark, sf, "events").schema
    source = spark.readStream.schema(kinds).option("pathGlobFilter", "events.parquet").parquet(sf)
    visits = source.select(F.col("event_type").alias("series"), F.col("event_id").cast("string").alias("Surrogate_Key"), F.col("ts").alias("Contact_Start"))
    path = _path(spark, "closed-days")
    write_closed_days(streaming_daily_counts(visits, S), path, _path(spark, "stream-state"))
    return spark.read.schema("series string, Date date, Patients_per_day bigint").parquet(path)


@query("preprocess_incremental", ORACLES["preprocess"])
def preprocess_incremental(spark, sf):
    """The result of `preprocess` from a state that three overlapping deliveries were merged into."""
    visits, path = i.visits(spark, sf).where(F.col("Contact_Start") < F.lit(AS_OF)), _path(spark, "daily-state")
    cuts = [dt.date(1990, 1, 1), dt.date(1994, 6, 1), dt.date(1997, 6, 1), dt.date(2100, 1, 1)]
    for first, last in zip(cuts, cuts[1:]):
        day = F.to_date("Contact_Start")
        merge_visits(visits.where((day >= F.date_sub(F.lit(first), 30)) & (day < F.lit(last))), path, S)
    daily = read_daily(spark, path, visits.select(*S).schema)
    return handle_outliers(gap_fill(daily, S), action="cap", series_cols=S)
