"""Run tables: intermediate results, performance history, metrics, parameters, registry snapshots."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.functions.shape import flatten_mapping
from daymark.operators.monitor import metric_records
from daymark.schema import MODEL_PERFORMANCE, RUN_METRICS, TRACKING_LOG, in_schema

#: Column that names the run in run tables.
RUN = "run"


def sink_intermediate(df: DataFrame, path: str, series_cols: Sequence[str] = ()) -> DataFrame:
    """Write a stage as parquet (a folder per series key if given) and read it back.

    Later stages then start from files, with short lineage and pushed filters. Rows are spread
    by key before the write so that each folder gets few files; a key with many rows is split
    by the writer's own rebalancing.
    """
    if series_cols:
        df.hint("rebalance", *series_cols).write.mode("overwrite").partitionBy(*series_cols).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    # The written types: inferred ones would turn text keys like 007 into numbers.
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def commit_run(rows: DataFrame, path: str, run_id: str) -> None:
    """Put the rows of one run into a run table at `path`, in place of what this run wrote before.

    The table is partitioned by `run`. Spark writes the rows to a staging folder first and moves the
    run's folder in when all tasks are done, so a task that is lost and starts again leaves each row
    once, a run that failed leaves nothing, and a repeated run replaces its own rows only.
    """
    named = rows.withColumn(RUN, F.lit(run_id))
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN).parquet(path)


def read_runs(spark: SparkSession, path: str, schema: T.StructType, with_run: bool = False) -> DataFrame:
    """The rows of all runs of a run table."""
    known = T.StructType([*[f for f in schema if f.name != RUN], T.StructField(RUN, T.StringType())])
    rows = spark.read.schema(known).parquet(path)
    return rows if with_run else rows.drop(RUN)


def append_performance(metrics: DataFrame, path: str, run_id: str | None = None) -> None:
    """Add evaluation rows to the performance history; those of a named run replace its earlier ones."""
    commit_run(in_schema(metrics, MODEL_PERFORMANCE), path, run_id or _new_run())


def append_tracking(log: DataFrame, path: str, series_cols: Sequence[str] = (), run_id: str | None = None) -> None:
    """Add the rows of one tracking run to its log; those of a named run replace its earlier ones."""
    extra = log.select(*series_cols).schema.fields
    commit_run(in_schema(log, T.StructType([*extra, *TRACKING_LOG])), path, run_id or _new_run())


def append_rows(df: DataFrame, path: str, run_id: str | None = None) -> None:
    """Add rows to a run table; those of a named run replace its earlier ones."""
    commit_run(df, path, run_id or _new_run())


def _new_run() -> str:
    return uuid.uuid4().hex


def write_snapshot(df: DataFrame, root: str, snapshot: int) -> str:
    """Whole new state of a small table in its own folder: readers of older ones are not disturbed."""
    path = f"{root.rstrip('/')}/snapshot={snapshot}"
    df.write.mode("errorifexists").parquet(path)
    return path


def params_rows(spark: SparkSession, run_id: str, params: Mapping[str, Any]) -> DataFrame:
    """Run parameters with dotted names, one row each."""
    rows = [(run_id, name, str(value)) for name, value in flatten_mapping(params).items()]
    return spark.createDataFrame(rows, "run_id string, name string, value string")


def metrics_rows(
    spark: SparkSession, run_id: str, metrics: Mapping[str, float], step: int | None = None
) -> DataFrame:
    rows = [(run_id, name, float(value), step) for name, value in metrics.items()]
    return spark.createDataFrame(rows, "run_id string, name string, value double, step int")


class MetricsLog:
    """Records run events as rows appended to the run_metrics table at `path`.

    Times are UTC, also those of a clock that names no zone. With a `run_id` the events of a run that
    is repeated in the same order replace those it recorded before.
    """

    def __init__(
        self, spark: SparkSession, path: str, clock=lambda: dt.datetime.now(dt.timezone.utc), run_id: str | None = None
    ):
        self.spark, self.path, self.clock, self.run_id, self.recorded = spark, path, clock, run_id, 0

    def read(self) -> DataFrame:
        return read_runs(self.spark, self.path, RUN_METRICS)

    def record(self, *events: tuple[Mapping[str, float], Mapping[str, object]]) -> None:
        """Append (values, labels) pairs of one moment in one write."""
        name = f"{self.run_id}-{self.recorded}" if self.run_id else None
        append_rows(metric_records(self.spark, self._now().replace(tzinfo=None), events), self.path, name)
        self.recorded += 1

    def _now(self) -> dt.datetime:
        moment = self.clock()
        return moment.astimezone(dt.timezone.utc) if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)

    def _epoch(self) -> float:
        return self._now().timestamp()

    def training(
        self, horizon, mae, rmse, coverage, interval_width, duration, n_trials, dataset="test", success=True
    ) -> None:
        quality = {
            "model_mae_by_horizon": mae,
            "model_rmse_by_horizon": rmse,
            "model_coverage_by_horizon": coverage,
            "model_interval_width_by_horizon": interval_width,
        }
        run = {
            "training_duration_seconds": duration,
            "optuna_trials_count": n_trials,
            "last_training_timestamp": self._epoch(),
        }
        self.record(
            (quality, {"horizon": horizon, "dataset": dataset}),
            ({"training_count_total": 1}, {"horizon": horizon, "status": _status(success)}),
            (run, {"horizon": horizon}),
        )

    def prediction(self, count, duration, success=True, horizon_counts=None) -> None:
        run = {"prediction_duration_seconds": duration, "last_prediction_timestamp": self._epoch()}
        made = [({"predictions_generated_total": n}, {"horizon": h}) for h, n in (horizon_counts or {}).items()]
        self.record(({"prediction_count_total": 1}, {"status": _status(success)}), (run, {}), *made)

    def data_processing(self, step, rows, duration) -> None:
        values = {"data_processing_duration_seconds": duration, "data_rows_processed": rows}
        self.record((values, {"step": step}))

    def weather(self, response_time, success=True, timeout=False) -> None:
        self.record(
            ({"weather_api_requests_total": 1}, {"status": "timeout" if timeout else _status(success)}),
            ({"weather_api_response_time_seconds": response_time}, {}),
        )

    def registration(self, horizon, stage="Staging") -> None:
        self.record(({"mlflow_model_registrations_total": 1}, {"horizon": horizon, "stage": stage}))

    def promotion(self, horizon) -> None:
        self.record(({"mlflow_model_promotions_total": 1}, {"horizon": horizon}))

    def flow_status(self, flow_name, success) -> None:
        self.record(({"flow_run_status": 1.0 if success else 0.0}, {"flow_name": flow_name}))


def _status(success: bool) -> str:
    return "success" if success else "failure"


def performance_rows(
    evaluated: DataFrame, model_version: str, day: dt.date, created_at: dt.datetime
) -> DataFrame:
    """Metrics by horizon as rows of the performance history."""
    return in_schema(
        evaluated.withColumns(
            {
                "evaluation_date": F.lit(day),
                "model_version": F.lit(model_version),
                "created_at": F.lit(created_at).cast("timestamp_ntz"),
            }
        ),
        MODEL_PERFORMANCE,
    )
