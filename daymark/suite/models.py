"""Queries for modelling, with all rows, series and horizons, the default parameters and the whole search space.

Numbers that come out of a fit have no SQL counterpart. What does not depend on the fit has one: which
rows are scored, sizes, order and finiteness of the results, and that the errors of the models are below those of
last week's count.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymark.functions.calendar import CYCLIC_NAMES, ONEHOT_NAMES
from daymark.ml.model import ForecastModel, score_by_horizon
from daymark.ml.params import DEFAULT_PARAMS, SEARCH_SPACE, trials
from daymark.ml.train import TrainedHorizon, search_all, train_all
from daymark.operators.dataset import temporal_split
from daymark.operators.evaluate import metrics_by_horizon
from daymark.operators.features import LAGS, ROLLING_WINDOWS, engineer_features, future_features
from daymark.operators.clean import drop_null_rows
from daymark.operators.weather import merge_weather
from daymark.plans import prediction, tracking, training
from daymark.schema import HORIZON, HORIZONS, LABEL, SPLIT, WEATHER
from daymark.session import cut_lineage, shared_folder
from daymark.sources.predictions import sink_test_predictions
from daymark.suite import inputs as i
from daymark.suite.catalog import query, with_ctes
from daymark.suite.features import FULL, FULL_STATE, LABELLED, split_sql
from daymark.suite.weather import MERGED

S = i.SERIES
TRIALS = 30
FEATURES = [
    *CYCLIC_NAMES,
    "Weekend",
    *ONEHOT_NAMES,
    *[f"patients_{n}d_{kind}" for n in ROLLING_WINDOWS for kind in ("avg", "std")],
    *[f"patients_lag_{k}" for k in LAGS],
    "patients_change_1d",
    "patients_change_7d",
    *WEATHER,
]
RUN_TIME = dt.datetime(2001, 8, 2, 6, 0)

_rows: dict[tuple[str, str], DataFrame] = {}
_trained: dict[tuple[str, str, str], dict[int, TrainedHorizon]] = {}


def forget() -> None:
    """Compute rows and fits anew in the next query (for the bench)."""
    _rows.clear()
    _trained.clear()


def _key(spark: SparkSession, sf: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, sf


def _run_name(spark: SparkSession, sf: str) -> str:
    return f"{spark.sparkContext.applicationId}_{sf.rstrip('/').rsplit('/', 1)[-1]}"


def training_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled feature rows, computed once per session and table folder."""
    key = _key(spark, sf)
    if key not in _rows:
        _rows[key] = cut_lineage(
            training.training_table(i.filled(spark, sf), i.weather(spark, sf), S, validate=False, materialize=True)
        )
    return _rows[key]


def trained(spark: SparkSession, sf: str, bounds: str = "residual") -> dict[int, TrainedHorizon]:
    """One model per horizon with the default parameters, fitted once per session and table folder."""
    key = (*_key(spark, sf), bounds)
    if key not in _trained:
        _trained[key] = train_all(
            training_rows(spark, sf), series_cols=S, features=FEATURES, bounds=bounds, table=[DEFAULT_PARAMS]
        )
    return _trained[key]


def _models(spark: SparkSession, sf: str, bounds: str = "residual") -> dict[int, ForecastModel]:
    return {h: t.model for h, t in trained(spark, sf, bounds).items()}


def _part(split: DataFrame, name: str) -> DataFrame:
    return split.where(F.col(SPLIT) == name)


ROWS = with_ctes(i.DAILY, i.FILLED, i.WEATHER_SQL, MERGED, FULL) + LABELLED
PARTS = ROWS + ", parts AS (" + split_sql("labelled", "series, horizon", 'series, horizon, "Date", target, patients_lag_7') + ")"
_TEST_ROWS = PARTS + """ SELECT series, "Date", horizon, target, true AS sound FROM parts WHERE split = 'test'"""


def _sound(scored: DataFrame, *more: str) -> DataFrame:
    """Keys, label, and whether the numbers are finite and the bounds in order."""
    point, big = F.col("point_prediction"), F.lit(1e12)
    sound = F.abs(point) < big
    if "lower_bound" in scored.columns:
        sound = sound & (F.col("lower_bound") <= point) & (point <= F.col("upper_bound"))
        sound = sound & (F.abs("lower_bound") < big) & (F.abs("upper_bound") < big)
    return scored.select("series", "Date", HORIZON, LABEL, *more, F.coalesce(sound, F.lit(False)).alias("sound"))


@query("fit_point", _TEST_ROWS)
def fit_point(spark, sf):
    """Scores of the test parts by all seven point models."""
    split = temporal_split(training_rows(spark, sf), series_cols=S)
    test = _part(split, "test")
    scored = score_by_horizon(test, _models(spark, sf)).drop("lower_bound", "upper_bound")
    return _sound(scored)


@query("fit_quantiles", _TEST_ROWS)
def fit_quantiles(spark, sf):
    """Boosted bounds of all seven horizons."""
    split = temporal_split(training_rows(spark, sf), series_cols=S)
    return _sound(score_by_horizon(_part(split, "test"), _models(spark, sf, "quantile")))


@query("predict_interval", _TEST_ROWS)
def predict_interval(spark, sf):
    """Bounds from residuals, all horizons."""
    split = temporal_split(training_rows(spark, sf), series_cols=S)
    return _sound(score_by_horizon(_part(split, "test"), _models(spark, sf)))


_TRIAL_ROWS = ", ".join(
    f"({n}, {p['n_estimators']}, {p['max_depth']}, {p['num_leaves']}, CAST({p['subsample']!r} AS DOUBLE))"
    for n, p in enumerate(trials(TRIALS, space=SEARCH_SPACE))
)


@query(
    "hyperparameter_search",
    PARTS
    + f""" SELECT horizon, CAST(trial AS INTEGER) AS trial, CAST(n_estimators AS INTEGER) AS n_estimators,
        CAST(max_depth AS INTEGER) AS max_depth, CAST(num_leaves AS INTEGER) AS num_leaves, subsample, true AS sound
      FROM (SELECT DISTINCT horizon FROM parts), (VALUES {_TRIAL_ROWS}) AS t(trial, n_estimators, max_depth, num_leaves, subsample)""",
)
def search(spark, sf):
    """Trials of each horizon, drawn from the whole space; sound ones have an error, and all their trees unless better ones stopped them."""
    split = temporal_split(training_rows(spark, sf), series_cols=S)
    rows = []
    for horizon, found in search_all(split, FEATURES, trials(TRIALS, space=SEARCH_SPACE)).items():
        for place, r in enumerate(found):
            p = r["params"]
            whole = r["n_trees"] == p["n_estimators"]
            sound = r["error"] is None and r["val_mae"] is not None and 0 < r["val_mae"] < 1e12
            if not whole:
                sound = sound and place > 0 and r["stopped_by"] is not None and r["stopped_by"] <= r["val_mae"]
            rows.append((horizon, r["trial"], p["n_estimators"], p["max_depth"], p["num_leaves"], p["subsample"], sound))
    kinds = "horizon int, trial int, n_estimators int, max_depth int, num_leaves int, subsample double, sound boolean"
    return spark.createDataFrame(rows, kinds)


def _metadata(spark, sf, names, kinds):
    rows = [tuple(t.metadata[n] for n in names) for _, t in sorted(trained(spark, sf).items())]
    return spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


_WEEKLY = "avg(abs(target - patients_lag_7))"


@query(
    "train_horizon",
    PARTS
    + f""" SELECT horizon, CAST(count(*) AS BIGINT) AS n_test, round({_WEEKLY}, 6) AS weekly_mae, true AS better, true AS covered
        FROM parts WHERE split = 'test' GROUP BY horizon""",
)
def train_horizon_query(spark, sf):
    """Error of each horizon's model on its test part, next to that of the count a week before; coverage of its bounds."""
    test = _part(temporal_split(training_rows(spark, sf), series_cols=S), "test")
    weekly = test.groupBy(HORIZON).agg(F.count("*").alias("n_test"), F.avg(F.abs(F.col(LABEL) - F.col("patients_lag_7"))).alias("weekly_mae"))
    found = _metadata(spark, sf, ["horizon", "test_mae", "test_coverage"], ["int", "double", "double"])
    return weekly.join(found, HORIZON).select(
        HORIZON,
        "n_test",
        F.round("weekly_mae", 6).alias("weekly_mae"),
        (F.col("test_mae") < F.col("weekly_mae")).alias("better"),
        F.col("test_coverage").between(0.90, 0.99).alias("covered"),
    )


_SIZES = ", ".join(
    f"CAST(count(*) FILTER (split = '{p}') AS BIGINT) AS n_{p}" for p in ("train", "val", "calib", "test")
)


@query(
    "train_all",
    f"{PARTS} SELECT horizon, {_SIZES}, CAST({len(FEATURES)} AS INTEGER) AS n_features FROM parts GROUP BY horizon",
)
def train_all_query(spark, sf):
    names = ["horizon", "n_train", "n_val", "n_calib", "n_test", "n_features"]
    return _metadata(spark, sf, names, ["int"] + ["bigint"] * 4 + ["int"])


@query(
    "feature_importance_topk",
    PARTS
    + """ SELECT horizon, CAST(rank AS INTEGER) AS rank, true AS sound
        FROM (SELECT DISTINCT horizon FROM parts), range(1, 21) AS t(rank)""",
)
def feature_importance(spark, sf):
    """The first features of each horizon's model; sound shares of the gain do not rise and are known features'."""
    parts = [
        m.feature_importance(spark, 20).withColumn(HORIZON, F.lit(h)) for h, m in sorted(_models(spark, sf).items())
    ]
    order = Window.partitionBy(HORIZON).orderBy(F.desc("importance"), "feature")
    ranked = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(order))
    before = F.coalesce(F.lag("importance").over(order), F.lit(1.0))
    sound = F.col("importance").between(0.0, before) & F.col("feature").isin(FEATURES)
    return ranked.select(HORIZON, "rank", sound.alias("sound"))


def _future(spark, sf):
    weather = i.weather(spark, sf)
    merged = merge_weather(i.filled(spark, sf), weather, series_cols=S, validate=False)
    features = drop_null_rows(engineer_features(merged, series_cols=S))
    forecast = weather.where(F.dayofmonth("Date") % 2 == 0)
    return future_features(features, forecast=forecast, series_cols=S)


@query("row_to_model", FULL_STATE + """ SELECT series, "Date", horizon, true AS sound FROM future""")
def row_to_model(spark, sf):
    """Every future row under the model of its horizon."""
    return _sound(score_by_horizon(_future(spark, sf), _models(spark, sf)).withColumn(LABEL, F.lit(None))).drop(LABEL)


def _predictions(spark, sf):
    return prediction.generate_predictions(_future(spark, sf), _models(spark, sf), RUN_TIME, "7", S)


@query(
    "generate_predictions",
    FULL_STATE
    + """ SELECT series, "Date" AS prediction_date, horizon, '7' AS model_version, true AS sound FROM future""",
)
def generate_predictions(spark, sf):
    """Predictions of all series with finite, ordered numbers."""
    rows = _predictions(spark, sf).withColumns({"Date": F.col("prediction_date"), LABEL: F.lit(None)})
    judged = _sound(rows, "model_version").drop(LABEL)
    return judged.withColumnRenamed("Date", "prediction_date")


@query(
    "generate_predictions_contract",
    FULL_STATE
    + """ SELECT series, TIMESTAMP '2001-08-02 06:00:00' AS prediction_timestamp, "Date" AS prediction_date, horizon,
            '7' AS model_version, true AS in_order FROM future""",
)
def generate_predictions_contract(spark, sf):
    point = F.col("point_prediction")
    in_order = (F.col("lower_bound") <= point) & (point <= F.col("upper_bound"))
    return _predictions(spark, sf).select(
        "series", "prediction_timestamp", "prediction_date", HORIZON, "model_version", in_order.alias("in_order")
    )


def _backtest(spark, sf):
    return tracking.backtest(training_rows(spark, sf), _models(spark, sf), S)


def _judged_metrics(metrics: DataFrame) -> DataFrame:
    """Sizes by horizon, and whether the errors are finite and in order and the coverage a share."""
    mae, rmse = F.col("mae"), F.col("rmse")
    sound = (mae > 0) & (mae <= rmse) & (rmse < 1e12) & F.col("coverage").between(0.5, 1.0) & (F.col("interval_width") > 0)
    return metrics.select(HORIZON, "n_samples", F.coalesce(sound, F.lit(False)).alias("sound"))


_SAMPLES = "SELECT horizon, CAST(count(*) AS BIGINT) AS n_samples, true AS sound FROM parts"


@query("backtest_metrics", f"{PARTS} {_SAMPLES} WHERE split = 'test' GROUP BY horizon")
def backtest_metrics(spark, sf):
    return _judged_metrics(_backtest(spark, sf)["metrics"])


@query(
    "backtest",
    PARTS
    + """ SELECT series, "Date" + horizon AS date, target AS actual, horizon, true AS in_order
        FROM parts WHERE split = 'test'""",
)
def backtest(spark, sf):
    rows = _backtest(spark, sf)["rows"]
    in_order = (F.col("lower_bound") <= F.col("predicted")) & (F.col("predicted") <= F.col("upper_bound"))
    return rows.select("series", "date", "actual", HORIZON, in_order.alias("in_order"))


@query(
    "sink_test_predictions",
    PARTS
    + """ SELECT horizon, CAST(count(*) AS BIGINT) AS n_samples, min("Date" + horizon) AS first_date,
            max("Date" + horizon) AS last_date FROM parts WHERE split = 'test' GROUP BY horizon""",
)
def sink_test(spark, sf):
    path = f"{shared_folder(spark)}/{_run_name(spark, sf)}/test_predictions"
    sink_test_predictions(_backtest(spark, sf)["rows"], path)
    return spark.read.parquet(path).groupBy(HORIZON).agg(
        F.count("*").alias("n_samples"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


@query(
    "load_models",
    FULL_STATE
    + """ SELECT series, "Date" AS prediction_date, horizon, true AS same_point FROM future""",
)
def load_models(spark, sf):
    """Saved, registered, promoted, looked up and loaded models score like the ones in memory."""
    root = f"{shared_folder(spark)}/{_run_name(spark, sf)}/models"
    fitted = trained(spark, sf)
    paths = {h: t.model.save(spark, f"{root}/horizon_{h}") for h, t in fitted.items()}
    results = training.result_rows(spark, fitted, paths, "daily_forecast")
    registry, _ = training.register_and_promote(training.empty_registry(spark), results, threshold=1e9)
    loaded = prediction.load_models(spark, registry)
    future = _future(spark, sf)
    names = ["series", "Date", HORIZON]
    first = score_by_horizon(future, _models(spark, sf)).select(*names, "point_prediction")
    again = score_by_horizon(future, loaded).select(*names, F.col("point_prediction").alias("_again"))
    return first.join(again, names).select(
        "series",
        F.col("Date").alias("prediction_date"),
        HORIZON,
        (F.col("point_prediction") == F.col("_again")).alias("same_point"),
    )


@query("metrics_of_models", f"{PARTS} {_SAMPLES} GROUP BY horizon")
def metrics_of_models(spark, sf):
    """Errors of the point models on all labelled rows, all horizons in one job."""
    scored = score_by_horizon(training_rows(spark, sf), _models(spark, sf))
    renamed = scored.withColumnsRenamed({LABEL: "actual", "point_prediction": "predicted"})
    return _judged_metrics(metrics_by_horizon(renamed))
