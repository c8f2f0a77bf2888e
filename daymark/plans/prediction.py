"""Prediction plan: newest state of every series, seven future days, scores with bounds."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.ml.model import ForecastModel, score_by_horizon
from daymark.operators.clean import drop_null_rows
from daymark.operators.evaluate import prediction_summary, run_metadata
from daymark.operators.features import engineer_features, future_features
from daymark.operators.registry import model_paths, model_version_lookup
from daymark.operators.validate import require_fresh, validate_predictions
from daymark.operators.weather import merge_weather
from daymark.plans.training import model_name
from daymark.schema import DATE, HORIZONS, PREDICTION
from daymark.session import cut_lineage
from daymark.sources.predictions import sink_predictions_csv, sink_predictions_table


def load_models(
    spark: SparkSession,
    registry: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    fallback_paths: Mapping[int, str] | None = None,
    prefix: str = "daily_forecast",
) -> dict[int, ForecastModel]:
    """The production model of each horizon, else the file given for it; none at all is an error."""
    names = spark.createDataFrame([(model_name(h, prefix), h) for h in horizons], "model_name string, h int")
    rows = model_paths(names, registry).join(names, "model_name").collect()  # one row per horizon
    paths = {r.h: r.path for r in rows if r.path}
    for h, path in (fallback_paths or {}).items():
        paths.setdefault(h, path)
    missing = [h for h in horizons if h not in paths]
    if missing:
        raise ValueError(f"no model for horizons {missing}")
    return {h: ForecastModel.load(spark, paths[h]) for h in horizons}


def production_version(spark: SparkSession, registry: DataFrame, prefix: str = "daily_forecast") -> str:
    """Version text of the first horizon's production model, `unknown` if there is none."""
    name = spark.createDataFrame([(model_name(1, prefix),)], "model_name string")
    return model_version_lookup(name, registry).first().model_version


def generate_predictions(
    future: DataFrame,
    models: Mapping[int, ForecastModel],
    run_time: dt.datetime,
    model_version: str = "unknown",
    series_cols: Sequence[str] = (),
) -> DataFrame:
    """Score each future row with its horizon's model; bounds default to the point."""
    scored = score_by_horizon(future, models)
    stamped = scored.withColumns(
        {
            "prediction_timestamp": F.lit(run_time).cast("timestamp_ntz"),
            "prediction_date": F.col(DATE),
            "model_version": F.lit(model_version),
        }
    )
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in PREDICTION]
    return stamped.select(*series_cols, *columns)


def predict_flow(
    daily: DataFrame,
    weather: DataFrame,
    forecast: DataFrame | None,
    models: Mapping[int, ForecastModel],
    run_time: dt.datetime,
    model_version: str = "unknown",
    series_cols: Sequence[str] = (),
    location_cols: Sequence[str] = (),
    as_of: dt.date | None = None,
    max_staleness_days: int = 1,
    min_rows: int = 60,
    check_freshness: bool = True,
    base_date: dt.date | None = None,
    table_path: str | None = None,
    csv_folder: str | None = None,
) -> dict[str, DataFrame]:
    """Gate, weather, features, scores, checks and writes; gives the predictions, their summary and the run's row.

    The daily series is computed once, before the gates, and so are the predictions, before the checks.
    """
    daily = cut_lineage(daily)
    if check_freshness:
        require_fresh(daily, as_of or run_time.date(), max_staleness_days, min_rows, series_cols)
    merged = merge_weather(daily, weather, series_cols=series_cols, location_cols=location_cols)
    features = drop_null_rows(engineer_features(merged, series_cols=series_cols))
    future = future_features(features, base_date, forecast, series_cols, location_cols)
    predictions = cut_lineage(generate_predictions(future, models, run_time, model_version, series_cols))
    validate_predictions(predictions)
    if table_path:
        sink_predictions_table(predictions, table_path, series_cols=series_cols)
    if csv_folder:
        sink_predictions_csv(predictions, csv_folder, run_time=run_time)
    return {"predictions": predictions, "summary": prediction_summary(predictions), "run": run_metadata(predictions)}
