"""Forecast quality: error metrics, interval metrics, calibration and prediction summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions import errors
from daymark.functions.quantiles import exact_quantiles
from daymark.schema import HORIZON, PREDICTION, in_schema

ALPHA = 0.05


def error_rows(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Per row the signed and the absolute error."""
    return df.withColumns(
        {
            "error": F.col(actual) - F.col(predicted),
            "abs_error": errors.absolute_error(actual, predicted),
        }
    )


def evaluate(
    df: DataFrame,
    by: Sequence[str] = (),
    actual: str = "actual",
    predicted: str = "predicted",
    lower: str = "lower_bound",
    upper: str = "upper_bound",
) -> DataFrame:
    """mae, rmse and sample size; coverage and width as well where bounds exist."""
    metrics = [
        errors.mae(actual, predicted).alias("mae"),
        errors.rmse(actual, predicted).alias("rmse"),
        F.count("*").alias("n_samples"),
    ]
    if lower in df.columns and upper in df.columns:
        metrics += [
            errors.coverage(actual, lower, upper).alias("coverage"),
            errors.interval_width(lower, upper).alias("interval_width"),
        ]
    return df.groupBy(*by).agg(*metrics)


def metrics_by_horizon(df: DataFrame, series_cols: Sequence[str] = (), **columns: str) -> DataFrame:
    return evaluate(df, [*series_cols, HORIZON], **columns)


def width_profile(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean, smallest and largest interval width."""
    width = F.col("upper_bound") - F.col("lower_bound")
    return df.groupBy(*by).agg(
        F.avg(width).alias("mean_width"),
        F.min(width).alias("min_width"),
        F.max(width).alias("max_width"),
    )


def conformal_calibration(
    df: DataFrame, by: Sequence[str] = (), alpha: float = ALPHA
) -> DataFrame:
    """Quantile of the absolute residuals over half the mean interval width.

    A factor above 1 means the intervals are too narrow on the calibration rows. The factor is
    reported, and applied only by `widen`.
    """
    residuals = df.withColumn("_residual", errors.absolute_error("actual", "predicted"))
    found = exact_quantiles(
        residuals,
        {"residual_quantile": ("_residual", 1 - alpha)},
        by,
        carry={"mean_width": errors.interval_width("lower_bound", "upper_bound")},
        few_groups=list(by) == [HORIZON],
    )
    factor = F.try_divide(F.col("residual_quantile"), F.col("mean_width") / 2)
    return found.select(*by, "residual_quantile", "mean_width", factor.alias("correction_factor"))


def widen(df: DataFrame, factor: float | str) -> DataFrame:
    """Scale both half widths around the point prediction."""
    scale = F.col(factor) if isinstance(factor, str) else F.lit(float(factor))
    point = F.col("predicted")
    return df.withColumns(
        {
            "lower_bound": point - (point - F.col("lower_bound")) * scale,
            "upper_bound": point + (F.col("upper_bound") - point) * scale,
        }
    )


def format_predictions(df: DataFrame) -> DataFrame:
    """The seven prediction columns, cast and in table order."""
    return in_schema(df, PREDICTION)


def _spread(df: DataFrame) -> DataFrame:
    return df.withColumn("_width", F.col("upper_bound") - F.col("lower_bound"))


def run_metadata(df: DataFrame, by: Sequence[str] = ("prediction_timestamp",)) -> DataFrame:
    """One row per prediction run: size, date range, point statistics, mean interval width."""
    return _spread(df).groupBy(*by).agg(
        F.count("*").alias("n_predictions"),
        F.min("prediction_date").alias("base_date"),
        F.max("prediction_date").alias("end_date"),
        F.avg("point_prediction").alias("mean_prediction"),
        F.min("point_prediction").alias("min_prediction"),
        F.max("point_prediction").alias("max_prediction"),
        F.stddev_samp("point_prediction").alias("std_prediction"),
        F.avg("_width").alias("avg_interval_width"),
    )


def prediction_summary(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Size, date range, mean, median, extremes and spread of points; mean and median width."""
    return exact_quantiles(
        _spread(df),
        {"median_prediction": ("point_prediction", 0.5), "median_interval_width": ("_width", 0.5)},
        by,
        carry={
            "n_predictions": F.count("*"),
            "prediction_date_start": F.min("prediction_date"),
            "prediction_date_end": F.max("prediction_date"),
            "mean_prediction": F.avg("point_prediction"),
            "min_prediction": F.min("point_prediction"),
            "max_prediction": F.max("point_prediction"),
            "std_prediction": F.stddev_samp("point_prediction"),
            "mean_interval_width": F.avg("_width"),
        },
        few_groups=list(by) == [HORIZON],
    )


def prediction_extremes(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Point statistics with the horizon of the lowest and highest point.

    Equal points: the smaller horizon.
    """
    point, horizon = F.col("point_prediction"), F.col(HORIZON)
    return _spread(df).groupBy(*by).agg(
        F.avg(point).alias("mean_prediction"),
        F.stddev_samp(point).alias("std_prediction"),
        F.avg("_width").alias("mean_interval_width"),
        F.min(point).alias("min_prediction"),
        F.min_by(horizon, F.struct(point, horizon)).alias("min_horizon"),
        F.max(point).alias("max_prediction"),
        F.max_by(horizon, F.struct(point, -horizon)).alias("max_horizon"),
    )


def predictions_per_horizon(df: DataFrame) -> DataFrame:
    return df.groupBy(HORIZON).agg(F.count("*").alias("n_predictions"))


def sort_predictions(df: DataFrame, by: str = HORIZON) -> DataFrame:
    """Reporting order by horizon or by prediction date, ties settled by the other columns."""
    rest = [c for c in ("prediction_date", HORIZON, "prediction_timestamp") if c != by and c in df.columns]
    return df.orderBy(by, *rest)


def training_summary(results: DataFrame) -> DataFrame:
    """Per-horizon report rows in horizon order, percentages as such."""
    return results.select(
        HORIZON,
        "mae",
        "rmse",
        (F.col("coverage") * 100).alias("coverage_pct"),
        "interval_width",
        F.when(F.col("promoted"), "Yes").otherwise("No").alias("promoted"),
        "version",
    ).orderBy(HORIZON)


def flow_totals(results: DataFrame, archived: DataFrame | None = None) -> DataFrame:
    """Models trained and promoted, their mean error, and the number of archived versions."""
    trained = results.select("promoted", "mae", F.lit(False).alias("_archived"))
    if archived is not None:
        nothing = [F.lit(None).cast(kind).alias(name) for name, kind in trained.dtypes[:2]]
        trained = trained.unionByName(archived.select(*nothing, F.lit(True).alias("_archived")))
    return trained.agg(
        F.count_if(~F.col("_archived")).alias("models_trained"),
        F.count_if("promoted").alias("models_promoted"),
        F.count_if("_archived").alias("models_archived"),
        F.avg("mae").alias("mean_mae"),
    )
