"""Forecast tracking against actuals, and queries over the run_metrics table.

run_metrics is long: `ts, metric, labels MAP<STRING,STRING>, value`. Every query combines
map-side on (labels), so one metric holding most of the rows is no harder than many.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.functions.errors import absolute_error
from daymark.functions.quantiles import exact_quantiles, histogram_quantile
from daymark.schema import HORIZON, HORIZONS, RUN_METRICS, series_window, whole

# Tracking window and alert threshold.
ROLLING_ROWS = 30
DEGRADATION_PCT = 20.0
# Bucket edges in seconds of the duration metrics.
BUCKETS = {
    "training_duration_seconds": [60, 300, 600, 1800, 3600, 7200, 14400],
    "prediction_duration_seconds": [1, 5, 10, 30, 60, 120, 300, 600, 900],
    "data_processing_duration_seconds": [0.1, 0.5, 1, 5, 10, 30, 60, 120],
    "weather_api_response_time_seconds": [0.1, 0.5, 1, 2, 5, 10, 30],
}
# Gauges that exist before any run, and the labels they carry.
PERFORMANCE_GAUGES = [
    "model_mae_by_horizon",
    "model_rmse_by_horizon",
    "model_coverage_by_horizon",
    "model_interval_width_by_horizon",
]
HORIZON_GAUGES = ["optuna_trials_count", "last_training_timestamp"]
# Labels that only take a handful of values.
BOUNDED_LABELS = {"horizon", "dataset", "status", "flow_name", "stage", "step"}
DATASETS = ["train", "val", "test"]
FLOWS = ["training_flow", "prediction_flow"]


def predictions_vs_actuals(
    predictions: DataFrame, actuals: DataFrame, series_cols: Sequence[str] = ()
) -> DataFrame:
    """Predictions whose day has an actual count, with the absolute error."""
    right = actuals.select(*series_cols, F.col("date").alias("_day"), "patient_count")
    condition = predictions["prediction_date"] == right["_day"]
    for c in series_cols:
        condition = condition & (predictions[c] == right[c])
    joined = predictions.join(right, condition, "inner")
    for c in series_cols:
        joined = joined.drop(right[c])
    error = absolute_error("point_prediction", "patient_count")
    return joined.withColumn("absolute_error", error).drop("_day")


def point_mae_by_horizon(compared: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    return compared.groupBy(*series_cols, HORIZON).agg(F.avg("absolute_error").alias("mae"))


def rolling_mae(
    compared: DataFrame,
    window_rows: int = ROLLING_ROWS,
    series_cols: Sequence[str] = (),
    with_overall: bool = False,
) -> DataFrame:
    """Mean and count of the last absolute errors, per horizon in order of prediction date.

    Several runs may have predicted one date; they follow each other by run time. A window
    partition holds one series and horizon: calendar days times runs per day. `with_overall`
    adds the mean over all rows of the series and horizon (`mae`) from the same sort.
    """
    w = series_window([*series_cols, HORIZON], ["prediction_date", "prediction_timestamp"])
    recent = w.rowsBetween(-(window_rows - 1), 0)
    overall = [F.avg("absolute_error").over(whole(w)).alias("mae")] if with_overall else []
    return compared.select(
        *series_cols,
        F.col("prediction_date").alias("date"),
        "prediction_timestamp",
        HORIZON,
        F.avg("absolute_error").over(recent).alias("rolling_mae"),
        F.count("absolute_error").over(recent).alias("n_predictions"),
        *overall,
    )


def latest_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("date", "prediction_timestamp")
) -> DataFrame:
    """The last row of each group in the given order (combines map-side, no sort of a group)."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return newest.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def degradation_alerts(
    rolling: DataFrame,
    baselines: DataFrame,
    threshold_pct: float = DEGRADATION_PCT,
    series_cols: Sequence[str] = (),
) -> DataFrame:
    """Groups whose newest rolling error exceeds the baseline by more than the threshold.

    `baselines` has the keys (series and horizon, or fewer) and `baseline_mae`.
    """
    keys = [*series_cols, HORIZON]
    newest = latest_per_group(rolling, keys)
    on = [c for c in keys if c in baselines.columns]
    compared = newest.join(baselines.select(*on, "baseline_mae"), on)
    limit = F.col("baseline_mae") * (1 + F.lit(threshold_pct) / 100)
    excess = F.try_divide(F.col("rolling_mae") - F.col("baseline_mae"), F.col("baseline_mae")) * 100
    return compared.where(F.col("rolling_mae") > limit).select(
        *keys,
        F.col("rolling_mae").alias("current_mae"),
        "baseline_mae",
        limit.alias("threshold_mae"),
        excess.alias("degradation_percentage"),
        F.col("prediction_timestamp").alias("timestamp"),
    )


def tracking_status(alerts: DataFrame, compared: DataFrame | None = None) -> DataFrame:
    """One row: `degraded` when there is any alert, else `healthy`.

    With the compared predictions also their number.
    """
    rows = alerts.select(F.lit(1).alias("_alert"), F.lit(0).alias("_evaluated"))
    if compared is not None:
        rows = rows.unionByName(compared.select(F.lit(0).alias("_alert"), F.lit(1).alias("_evaluated")))
    n = F.coalesce(F.sum("_alert"), F.lit(0))
    evaluated = F.coalesce(F.sum("_evaluated"), F.lit(0)).alias("n_predictions_evaluated")
    return rows.agg(
        n.cast("bigint").alias("n_alerts"),
        F.when(n > 0, "degraded").otherwise("healthy").alias("status"),
        *([evaluated] if compared is not None else []),
    )


# ---- run_metrics -------------------------------------------------------------------------


def label(name: str) -> Column:
    return F.try_element_at(F.col("labels"), F.lit(name))


def pick(metrics: DataFrame, metric: str, **labels: str) -> DataFrame:
    """Rows of one metric with the given label values."""
    rows = metrics.where(F.col("metric") == metric)
    for name, value in labels.items():
        rows = rows.where(label(name) == str(value))
    return rows


def by_labels(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """Labels as columns."""
    return metrics.select("ts", "metric", "value", *[label(n).alias(n) for n in names])


def current_metric(metrics: DataFrame, labels: Sequence[str] = (HORIZON,), scale: float = 1.0) -> DataFrame:
    """Newest value per metric and labels; of values with one time stamp the largest."""
    rows = by_labels(metrics, labels)
    newest = F.max_by("value", "ts") * F.lit(float(scale))
    return _by_time(rows, labels).groupBy("metric", *labels).agg(newest.alias("value"), F.max("ts").alias("ts"))


def _by_time(rows: DataFrame, labels: Sequence[str]) -> DataFrame:
    """The largest value of each moment: fixed-width buffers, so both steps hash and combine map-side."""
    return rows.groupBy("metric", *labels, "ts").agg(F.max("value").alias("value"))


def duration_quantiles(
    metrics: DataFrame, probs: Sequence[float] = (0.5, 0.95, 0.99), labels: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles of raw durations."""
    return exact_quantiles(
        by_labels(metrics, labels),
        {f"p{round(p * 100):02d}": ("value", p) for p in probs},
        ["metric", *labels],
        carry={"n": F.count("value")},
        few_groups=set(labels) <= BOUNDED_LABELS,
    )


def bucketed_quantiles(
    metrics: DataFrame,
    edges: Sequence[float],
    probs: Sequence[float] = (0.5, 0.95, 0.99),
    labels: Sequence[str] = (),
) -> DataFrame:
    """Quantiles estimated from bucket counts."""
    return histogram_quantile(by_labels(metrics, labels), "value", edges, probs, ["metric", *labels])


def counter_rate(
    metrics: DataFrame,
    window: str = "1 hour",
    per: float = 1.0,
    labels: Sequence[str] = (),
    slide: str | None = None,
) -> DataFrame:
    """Increase per `per` seconds in each time window, which may slide."""
    rows = by_labels(metrics, labels)
    span = F.window("ts", window, slide) if slide else F.window("ts", window)
    seconds = F.timestamp_diff("SECOND", F.col("_w.start"), F.col("_w.end"))
    rate = F.col("_sum") / seconds * F.lit(float(per))
    return rows.groupBy("metric", *labels, span.alias("_w")).agg(F.sum("value").alias("_sum")).select(
        "metric", *labels, F.col("_w.start").alias("window_start"), rate.alias("rate")
    )


def success_rate(
    metrics: DataFrame, by: Sequence[str] = ("metric",), labels: Sequence[str] = ()
) -> DataFrame:
    """Increments with status `success` in percent of all."""
    rows = by_labels(metrics, ["status", *labels])
    succeeded = F.sum(F.when(F.col("status") == "success", F.col("value")).otherwise(F.lit(0.0)))
    rate = F.try_divide(succeeded, F.sum("value")) * 100
    return rows.groupBy(*by).agg(rate.alias("success_pct"))


def counter_totals(metrics: DataFrame, labels: Sequence[str] = ()) -> DataFrame:
    return by_labels(metrics, labels).groupBy("metric", *labels).agg(F.sum("value").alias("total"))


def last_run(metrics: DataFrame, labels: Sequence[str] = ()) -> DataFrame:
    """Time and value of the newest row per metric and labels."""
    rows = by_labels(metrics, labels)
    return _by_time(rows, labels).groupBy("metric", *labels).agg(
        F.max("ts").alias("last_ts"), F.max_by("value", "ts").alias("last_value")
    )


def metric_grid(spark: SparkSession) -> DataFrame:
    """Every gauge that must exist: a fixed list of (metric, horizon, dataset, flow_name)."""
    rows = [(m, str(h), d, None) for m in PERFORMANCE_GAUGES for h in HORIZONS for d in DATASETS]
    rows += [(m, str(h), None, None) for m in HORIZON_GAUGES for h in HORIZONS]
    rows += [("flow_run_status", None, None, flow) for flow in FLOWS]
    rows.append(("last_prediction_timestamp", None, None, None))
    return spark.createDataFrame(rows, "metric string, horizon string, dataset string, flow_name string")


def metric_defaults(metrics: DataFrame) -> DataFrame:
    """Newest value of every gauge in the grid, 0 where nothing was recorded yet."""
    keys = ["horizon", "dataset", "flow_name"]
    grid = metric_grid(metrics.sparkSession)
    names = [*PERFORMANCE_GAUGES, *HORIZON_GAUGES, "flow_run_status", "last_prediction_timestamp"]
    known = current_metric(metrics.where(F.col("metric").isin(*names)), keys).select("metric", *keys, F.col("value").alias("_value"))
    condition = grid["metric"] == known["metric"]
    for k in keys:
        condition = condition & grid[k].eqNullSafe(known[k])
    return grid.join(known, condition, "left").select(
        grid["metric"], *[grid[k] for k in keys], F.coalesce("_value", F.lit(0.0)).alias("value")
    )


def metric_records(
    spark: SparkSession,
    ts: object,
    events: Sequence[tuple[Mapping[str, float], Mapping[str, object]]],
) -> DataFrame:
    """run_metrics rows of one moment: each event is a set of values under the same labels."""
    rows = [
        (ts, name, {k: str(v) for k, v in labels.items()}, float(value))
        for values, labels in events
        for name, value in values.items()
    ]
    return spark.createDataFrame(rows, RUN_METRICS)
