"""Training plan: daily series and weather to registered, promoted models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.ml.train import TrainedHorizon, train_all
from daymark.operators import registry as reg
from daymark.operators.dataset import training_rows
from daymark.operators.evaluate import flow_totals, training_summary
from daymark.operators.features import engineer_for_horizons
from daymark.operators.weather import merge_weather
from daymark.schema import HORIZONS, REGISTRY
from daymark.session import cut_lineage
from daymark.sources import tables

RESULTS = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("horizon", T.IntegerType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("coverage", T.DoubleType()),
        T.StructField("interval_width", T.DoubleType()),
        T.StructField("path", T.StringType()),
    ]
)


def model_name(horizon: int, prefix: str = "daily_forecast") -> str:
    return f"{prefix}_horizon_{horizon}"


def training_table(
    daily: DataFrame,
    weather: DataFrame,
    series_cols: Sequence[str] = (),
    location_cols: Sequence[str] = (),
    fallback: str = "last_known",
    lossless: bool = False,
    validate: bool = True,
    materialize: bool = False,
    **switches: bool,
) -> DataFrame:
    """Complete, labelled feature rows for all horizons.

    The weather of a target day comes from the merged and filled series, so a day past the end
    of the series has none, and its rows are dropped. The merged series is used twice, so
    `materialize` checkpoints it, and the raw visits behind it are read and shuffled once.
    """
    merged = merge_weather(daily, weather, fallback, series_cols, location_cols, validate)
    if materialize:
        merged = cut_lineage(merged)
    keys = [*dict.fromkeys([*series_cols, *location_cols])]
    lookup = merged.select(*keys, "Date", *[c for c in merged.columns if c not in daily.columns])
    features = engineer_for_horizons(merged, lookup, series_cols=series_cols, location_cols=keys, **switches)
    return training_rows(features, series_cols, lossless=lossless)


def result_rows(
    spark: SparkSession, trained: Mapping[int, TrainedHorizon], paths: Mapping[int, str], prefix: str
) -> DataFrame:
    rows = [
        (
            model_name(h, prefix),
            h,
            t.metadata["test_mae"],
            t.metadata["test_rmse"],
            t.metadata["test_coverage"],
            t.metadata["test_interval_width"],
            paths.get(h),
        )
        for h, t in sorted(trained.items())
    ]
    return spark.createDataFrame(rows, RESULTS)


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTRY)


def _promoted(
    registry: DataFrame, results: DataFrame, threshold: float, require_both: bool
) -> tuple[DataFrame, DataFrame]:
    """Registry before retention, and the results with version and decision.

    The error is written to the tags of each new version, so the next run has a baseline.
    """
    text = F.col("mae").cast("string")
    candidates = results.withColumns(
        {
            "tags": F.create_map(F.lit("mae"), text, F.lit("horizon"), F.col("horizon").cast("string")),
            "description": F.lit(None).cast("string"),
            "arrival": F.col("horizon"),
        }
    )
    new_rows = reg.register_version(registry, candidates)
    decided = reg.promotion_decision(reg.candidate_vs_baseline(results, registry), threshold, require_both)
    decided = decided.join(new_rows.select("model_name", "version"), "model_name")
    grown = registry.unionByName(new_rows.select(*registry.columns))
    return reg.promote(grown, decided.where("promoted")), decided


def register_and_promote(
    registry: DataFrame,
    results: DataFrame,
    threshold: float = reg.MAE_THRESHOLD,
    keep_n: int = reg.KEEP_VERSIONS,
    require_both: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """New registry state, and the results with version and decision."""
    promoted, decided = _promoted(registry, results, threshold, require_both)
    return reg.keep_latest_versions(promoted, keep_n), decided


def train_flow(
    daily: DataFrame,
    weather: DataFrame,
    registry: DataFrame,
    model_root: str,
    run_id: str,
    series_cols: Sequence[str] = (),
    location_cols: Sequence[str] = (),
    horizons: Sequence[int] = HORIZONS,
    n_trials: int = 300,
    threshold: float = reg.MAE_THRESHOLD,
    prefix: str = "daily_forecast",
    log_path: str | None = None,
    **options: Any,
) -> dict[str, Any]:
    """Features, models for every horizon, registration, promotion, retention and the report.

    With `log_path` the chosen parameters and the metrics of each model are added to run tables there;
    a repeated `run_id` replaces its rows.
    The daily series is computed once, before the checks and the features.
    """
    spark = daily.sparkSession
    daily = cut_lineage(daily)
    rows = training_table(daily, weather, series_cols, location_cols, materialize=True).persist()
    try:
        trained = train_all(rows, horizons, n_trials, series_cols, **options)
    finally:
        rows.unpersist()
    paths = {
        h: t.model.save(spark, f"{model_root.rstrip('/')}/{run_id}/horizon_{h}") for h, t in trained.items()
    }
    results = result_rows(spark, trained, paths, prefix)
    promoted, decided = _promoted(registry, results, threshold, False)
    if log_path:
        for h, t in sorted(trained.items()):
            run = f"{run_id}/{model_name(h, prefix)}"
            numbers = {k: v for k, v in t.metadata.items() if isinstance(v, (int, float)) and not isinstance(v, bool)}
            tables.append_rows(tables.params_rows(spark, run, t.metadata["best_params"]), f"{log_path}/params", f"{run_id}-{h}")
            tables.append_rows(tables.metrics_rows(spark, run, numbers), f"{log_path}/metrics", f"{run_id}-{h}")
    return {
        "trained": trained,
        "registry": reg.keep_latest_versions(promoted),
        "results": decided,
        "summary": training_summary(decided),
        "totals": flow_totals(decided, reg.newly_archived(promoted)),
    }
