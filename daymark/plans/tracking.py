"""Backtest of trained models and tracking of written predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.ml.model import ForecastModel, score_by_horizon
from daymark.operators import monitor
from daymark.operators.dataset import temporal_split
from daymark.operators.evaluate import metrics_by_horizon
from daymark.schema import DATE, HORIZON, LABEL, SPLIT
from daymark.session import cut_lineage
from daymark.sources.tables import append_tracking


def newest_part(rows: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """The newest fifth of each series and horizon."""
    return temporal_split(rows, series_cols=series_cols).where(F.col(SPLIT) == "test").drop(SPLIT)


def backtest_rows(scored: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """Scored rows labelled with the day they are about."""
    return scored.select(
        *series_cols,
        F.date_add(DATE, F.col(HORIZON)).alias("date"),
        F.col(LABEL).alias("actual"),
        F.col("point_prediction").alias("predicted"),
        "lower_bound",
        "upper_bound",
        HORIZON,
    )


def backtest(
    rows: DataFrame, models: Mapping[int, ForecastModel], series_cols: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Score the test part of labelled feature rows, all horizons in one job."""
    scored = backtest_rows(score_by_horizon(newest_part(rows, series_cols), models), series_cols)
    return {"rows": scored, "metrics": metrics_by_horizon(scored)}


def track_performance(
    predictions: DataFrame,
    actuals: DataFrame,
    baselines: DataFrame | None = None,
    window_rows: int = monitor.ROLLING_ROWS,
    threshold_pct: float = monitor.DEGRADATION_PCT,
    series_cols: Sequence[str] = (),
    log_path: str | None = None,
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    """Rolling and overall error per horizon, the row to log for each, alerts and status.

    With `log_path` the rows are added to the log there; those of a `run_id` that is repeated replace its earlier ones.
    """
    keys = [*series_cols, HORIZON]
    compared = monitor.predictions_vs_actuals(predictions, actuals, series_cols)
    # All results come from it: one sort gives both errors of a group, and its newest row carries them.
    both = cut_lineage(monitor.rolling_mae(compared, window_rows, series_cols, with_overall=True))
    rolling = both.drop("mae")
    log = monitor.latest_per_group(both, keys).select(
        *keys, "mae", "rolling_mae", "n_predictions", F.col("prediction_timestamp").alias("timestamp")
    )
    overall = log.select(*keys, "mae")
    report = {"rolling": rolling, "overall": overall, "log": log}
    if baselines is not None:
        report["alerts"] = monitor.degradation_alerts(rolling, baselines, threshold_pct, series_cols)
        report["status"] = monitor.tracking_status(report["alerts"], both)
    if log_path:
        append_tracking(log, log_path, series_cols, run_id)
    return report
