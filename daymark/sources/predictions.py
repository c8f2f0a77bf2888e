"""Prediction tables: reading and writing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.operators.evaluate import format_predictions
from daymark.schema import ACTUALS, HORIZON, PREDICTION, nan_to_null
from daymark.sources.visits import is_bracketed_name

IF_EXISTS = ("append", "replace", "fail")


def scan_predictions(spark: SparkSession, path: str, series_cols: Sequence[str] = ()) -> DataFrame:
    """Prediction files with the series columns (as text) that stand before the seven others.

    The names in the files are compared with these columns, so a file with others is an error.
    """
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in series_cols], *PREDICTION])
    files = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return nan_to_null(files.csv(path))


def scan_actuals(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ACTUALS).option("header", True).csv(path)


def sink_predictions_csv(
    predictions: DataFrame,
    folder: str,
    include_timestamp: bool = True,
    run_time: dt.datetime | None = None,
) -> str:
    """Write a run as CSV and return its path: columns that are none of the seven (a series) first, then these.

    The result is a folder named after the run with one part per task; nothing is gathered.
    """
    stamp = (run_time or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
    name = f"predictions_{stamp}.csv" if include_timestamp else "predictions_latest.csv"
    path = f"{folder.rstrip('/')}/{name}"
    extra = [c for c in predictions.columns if c not in PREDICTION.fieldNames()]
    with_extra_keys(predictions, extra).write.mode("overwrite").option("header", True).csv(path)
    return path


def _check_if_exists(if_exists: str) -> None:
    if if_exists not in IF_EXISTS:
        raise ValueError(f"if_exists must be one of {IF_EXISTS}")


def _read_or_none(rows: DataFrame, path: str) -> DataFrame | None:
    # The rows' own types: inferred ones would turn text keys like 007 into numbers.
    try:
        return rows.sparkSession.read.schema(rows.schema).parquet(path)
    except AnalysisException:
        return None


def sink_predictions_table(
    predictions: DataFrame,
    path: str,
    if_exists: str = "append",
    series_cols: Sequence[str] = (),
) -> int:
    """Append to a parquet table partitioned by horizon; returns the number of new rows.

    Rows of a run time, predicted day, horizon and series that are already in the table are not written
    again, so a repeated write of the same run changes nothing, and other series or days of one
    run time are added. `fail` refuses a table with rows; `replace` acts as append.
    """
    _check_if_exists(if_exists)
    run_keys = ["prediction_timestamp", "prediction_date", HORIZON, *series_cols]
    rows = with_extra_keys(predictions, run_keys)
    if rows.isEmpty():
        return 0
    present = _read_or_none(rows, path)
    if present is not None:
        if if_exists == "fail" and not present.isEmpty():
            raise ValueError(f"table {path} already has rows")
        # Only runs of the new rows' times are read, not the keys of the whole history.
        first, last = rows.agg(F.min("prediction_timestamp"), F.max("prediction_timestamp")).first()
        same = present.where(F.col("prediction_timestamp").between(F.lit(first), F.lit(last)))
        rows = rows.join(same.select(*run_keys).distinct(), run_keys, "left_anti")
    written = Observation()
    counted = rows.observe(written, F.count(F.lit(1)).alias("n"))  # counts while it writes
    counted.write.mode("append").partitionBy(HORIZON).parquet(path)
    return written.get["n"]


def with_extra_keys(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The prediction columns, plus key columns (a series, say) that are not among them."""
    extra = [k for k in keys if k not in PREDICTION.fieldNames()]
    if not extra:
        return format_predictions(predictions)
    casts = [F.col(f.name).cast(f.dataType).alias(f.name) for f in PREDICTION]
    return predictions.select(*extra, *casts)


def sink_predictions_db(
    predictions: DataFrame,
    url: str,
    table: str,
    if_exists: str = "append",
    properties: Mapping[str, str] | None = None,
    series_cols: Sequence[str] = (),
) -> int:
    """Append the series and prediction columns to a database table; returns the number of rows.

    Executors write in parallel. A retried task could repeat its rows, so point `table` at a staging
    table and merge by (prediction_timestamp, prediction_date, horizon) and the series columns on the
    database side.
    """
    if not url:
        raise ValueError("the connection URL must not be empty")
    _check_if_exists(if_exists)
    if not is_bracketed_name(table):
        raise ValueError(f"invalid table name {table!r}")
    rows = with_extra_keys(predictions, series_cols)
    if rows.isEmpty():
        return 0
    options = dict(properties or {})
    spark = predictions.sparkSession
    if if_exists == "fail" and not spark.read.jdbc(url, table, properties=options).isEmpty():
        raise ValueError(f"table {table} already has rows")
    written = Observation()
    counted = rows.observe(written, F.count(F.lit(1)).alias("n"))  # counts while it writes
    counted.write.jdbc(url, table, mode="append", properties=options)
    return written.get["n"]


def sink_test_predictions(scored: DataFrame, path: str) -> None:
    """Backtest rows, one folder per horizon; reading the parent gives the combined table."""
    scored.write.mode("overwrite").partitionBy(HORIZON).parquet(path)
