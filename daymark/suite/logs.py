"""Queries that write whole tables through the sinks and read them back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from daymark.operators import monitor
from daymark.operators.evaluate import metrics_by_horizon
from daymark.operators.weather import merge_weather
from daymark.schema import MODEL_PERFORMANCE
from daymark.session import shared_folder
from daymark.sources import predictions as sinks
from daymark.sources import tables
from daymark.suite import inputs as i
from daymark.suite.catalog import query, rounded, rounded_sql, with_ctes
from daymark.suite.quality import METRICS_SQL, PRED
from daymark.suite.weather import BASE as WEATHER_BASE

S = i.SERIES
_COLUMNS = "prediction_timestamp, prediction_date, horizon, model_version, point_prediction, lower_bound, upper_bound"


def _path(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("sink_predictions_table", f"{PRED} SELECT series, {_COLUMNS} FROM predictions")
def sink_predictions_table(spark, sf):
    """All series of a run in two writes, one of them repeated: each row is there once."""
    made, path = i.predictions(spark, sf), _path(spark, "predictions")
    first = made.where("horizon <= 4")
    for rows in (first, first, made):
        sinks.sink_predictions_table(rows, path, series_cols=S)
    return spark.read.schema(sinks.with_extra_keys(made, S).schema).parquet(path).select("series", *_COLUMNS.split(", "))


@query("sink_predictions_csv", f"{PRED} SELECT series, {_COLUMNS} FROM predictions")
def sink_predictions_csv(spark, sf):
    """All series of a run, written and read back with their series."""
    rows = i.predictions(spark, sf).select(*_COLUMNS.split(", "), "series")
    return sinks.scan_predictions(spark, sinks.sink_predictions_csv(rows, _path(spark, "csv")), S)


@query(
    "sink_intermediate",
    """SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS key, c_nationkey, c_acctbal FROM customer""",
)
def sink_intermediate(spark, sf):
    """Text keys with leading zeros keep them."""
    rows = i.table(spark, sf, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("key"), "c_nationkey", "c_acctbal"
    )
    return tables.sink_intermediate(rows.repartition(4), _path(spark, "stage"), ["c_nationkey"])


@query(
    "append_performance",
    rounded_sql(
        with_ctes(i.SCORES)
        + f""" SELECT DATE '2001-08-02' AS evaluation_date, '7' AS model_version, horizon, mae, rmse, coverage, interval_width
             FROM (SELECT horizon, {METRICS_SQL} FROM scores GROUP BY horizon)""",
        ["mae", "rmse", "coverage", "interval_width"],
    ),
)
def append_performance(spark, sf):
    path = _path(spark, "performance")
    rows = tables.performance_rows(metrics_by_horizon(i.scores(spark, sf)), "7", dt.date(2001, 8, 2), dt.datetime(2001, 8, 2, 6))
    for _ in range(2):  # a repeated run leaves its rows once
        tables.append_performance(rows, path, "2001-08-02")
    return rounded(tables.read_runs(spark, path, MODEL_PERFORMANCE).drop("created_at"))


@query(
    "experiment_log",
    rounded_sql(
        with_ctes(i.SCORES)
        + f""", m AS (SELECT horizon, {METRICS_SQL} FROM scores GROUP BY horizon)
          SELECT 'run/' || horizon AS run_id, name, value FROM m UNPIVOT (value FOR name IN (mae, rmse, coverage, interval_width))""",
        ["value"],
    ),
)
def experiment_log(spark, sf):
    """Metrics of each horizon's run, run by run; the first runs are repeated."""
    path, names = _path(spark, "experiments"), ["mae", "rmse", "coverage", "interval_width"]
    found = metrics_by_horizon(i.scores(spark, sf)).collect()  # one row per horizon
    for row in [*found[:2], *found]:
        rows = tables.metrics_rows(spark, f"run/{row.horizon}", {n: row[n] for n in names})
        tables.append_rows(rows, path, f"run-{row.horizon}")
    return rounded(spark.read.parquet(path).select("run_id", "name", "value"))


@query(
    "record_metrics",
    rounded_sql(
        with_ctes(i.SCORES)
        + f""" SELECT 'model_mae_by_horizon' AS metric, CAST(horizon AS VARCHAR) AS horizon, mae AS value
             FROM (SELECT horizon, {METRICS_SQL} FROM scores GROUP BY horizon)""",
        ["value"],
    ),
)
def record_metrics(spark, sf):
    """Errors recorded as run events and read back as current values."""
    log = tables.MetricsLog(spark, _path(spark, "metrics"), lambda: dt.datetime(2001, 8, 2, 6, tzinfo=dt.timezone.utc))
    for row in metrics_by_horizon(i.scores(spark, sf)).collect():  # one row per horizon
        log.training(row.horizon, row.mae, row.rmse, row.coverage, row.interval_width, 1.0, 1)
    current = monitor.current_metric(monitor.pick(log.read(), "model_mae_by_horizon"))
    return rounded(current.select("metric", "horizon", "value"))


@query(
    "merge_weather_repeated",
    rounded_sql(WEATHER_BASE + " SELECT * FROM merged WHERE Temp_Max IS NOT NULL", ["Temp_Max", "Temp_Min", "Temp_Mean", "Precipitation", "Snowfall"]),
)
def merge_weather_repeated(spark, sf):
    """Weather that was delivered twice gives each day once."""
    weather = i.weather(spark, sf)
    merged = merge_weather(i.filled(spark, sf), weather.union(weather), "zero", S, validate=False)
    known = weather.select("Date").distinct()
    return rounded(merged.join(known, "Date", "left_semi"))
