"""Queries for metrics, calibration, prediction tables and validators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daymark.functions import errors, shape
from daymark.functions.quantiles import exact_quantiles
from daymark.functions.shape import flatten_params, metric_rows
from daymark.operators import evaluate as ev
from daymark.operators.registry import newly_archived
from daymark.operators import validate
from daymark.schema import MODEL_PERFORMANCE, PREDICTION
from daymark.suite import inputs as i
from daymark.suite.catalog import query, rounded, rounded_sql, with_ctes

S = i.SERIES
SCORES = with_ctes(i.SCORES)
PRED = with_ctes(i.DAILY, i.PREDICTIONS)
AS_OF = dt.date(2001, 8, 2)

METRICS_SQL = """avg(abs(actual - predicted)) AS mae, sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
  CAST(count(*) AS BIGINT) AS n_samples,
  avg(CASE WHEN actual BETWEEN lower_bound AND upper_bound THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS coverage,
  avg(upper_bound - lower_bound) AS interval_width"""
METRIC_NAMES = ["mae", "rmse", "coverage", "interval_width"]


def _one(name: str, sql: str, column):
    @query(name, rounded_sql(f"{SCORES} SELECT {sql} AS {name} FROM scores", [name]))
    def run(spark, sf):
        return rounded(i.scores(spark, sf).agg(column().alias(name)))

    return run


_one("mae", "avg(abs(actual - predicted))", lambda: errors.mae("actual", "predicted"))
_one(
    "rmse",
    "sqrt(avg((actual - predicted) * (actual - predicted)))",
    lambda: errors.rmse("actual", "predicted"),
)
_one(
    "coverage",
    "avg(CASE WHEN actual BETWEEN lower_bound AND upper_bound THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)",
    lambda: errors.coverage("actual", "lower_bound", "upper_bound"),
)
_one(
    "mape",
    "100 * avg(abs((actual - predicted) / (actual + 1)))",
    lambda: errors.mape("actual", "predicted"),
)


@query(
    "interval_width",
    rounded_sql(
        SCORES
        + """ SELECT horizon, avg(upper_bound - lower_bound) AS mean_width, min(upper_bound - lower_bound) AS min_width,
                max(upper_bound - lower_bound) AS max_width FROM scores GROUP BY horizon""",
        ["mean_width"],
    ),
)
def interval_width(spark, sf):
    return rounded(ev.width_profile(i.scores(spark, sf), ["horizon"]))


@query("evaluate", rounded_sql(f"{SCORES} SELECT {METRICS_SQL} FROM scores", METRIC_NAMES))
def evaluate(spark, sf):
    return rounded(ev.evaluate(i.scores(spark, sf)))


@query(
    "evaluate_rows",
    SCORES + " SELECT *, actual - predicted AS error, abs(actual - predicted) AS abs_error FROM scores",
)
def evaluate_rows(spark, sf):
    return ev.error_rows(i.scores(spark, sf))


@query(
    "metrics_by_horizon",
    rounded_sql(f"{SCORES} SELECT horizon, {METRICS_SQL} FROM scores GROUP BY horizon", METRIC_NAMES),
)
def metrics_by_horizon(spark, sf):
    return rounded(ev.metrics_by_horizon(i.scores(spark, sf)))


@query(
    "conformal_calibration",
    rounded_sql(
        SCORES
        + """ SELECT horizon, quantile_cont(abs(actual - predicted), 0.95) AS residual_quantile,
                avg(upper_bound - lower_bound) AS mean_width,
                quantile_cont(abs(actual - predicted), 0.95) / (avg(upper_bound - lower_bound) / 2) AS correction_factor
            FROM scores GROUP BY horizon""",
        ["residual_quantile", "mean_width", "correction_factor"],
    ),
)
def conformal_calibration(spark, sf):
    return rounded(ev.conformal_calibration(i.scores(spark, sf), ["horizon"]))


@query(
    "conformal_calibration_all",
    rounded_sql(
        SCORES
        + """ SELECT quantile_cont(abs(actual - predicted), 0.9) AS residual_quantile,
                avg(upper_bound - lower_bound) AS mean_width,
                quantile_cont(abs(actual - predicted), 0.9) / (avg(upper_bound - lower_bound) / 2) AS correction_factor
            FROM scores""",
        ["residual_quantile", "mean_width", "correction_factor"],
    ),
)
def conformal_calibration_all(spark, sf):
    return rounded(ev.conformal_calibration(i.scores(spark, sf), alpha=0.1))


@query(
    "exact_quantiles",
    rounded_sql(
        """SELECT l_returnflag, CAST(count(l_extendedprice) AS BIGINT) AS n, quantile_cont(l_extendedprice, 0.025) AS low,
             quantile_cont(l_extendedprice, 0.5) AS middle, quantile_cont(l_extendedprice, 0.975) AS high
           FROM lineitem GROUP BY 1""",
        ["low", "middle", "high"],
    ),
)
def quantiles(spark, sf):
    found = exact_quantiles(
        i.table(spark, sf, "lineitem"),
        {"low": ("l_extendedprice", 0.025), "middle": ("l_extendedprice", 0.5), "high": ("l_extendedprice", 0.975)},
        ["l_returnflag"],
        carry={"n": F.count("l_extendedprice")},
    )
    return rounded(found)


@query(
    "clamp_bounds",
    """SELECT l_linenumber AS horizon, l_quantity AS point_prediction,
         least(l_quantity, l_quantity + CAST(round(l_discount * 100) AS INTEGER) - 7) AS lower_bound,
         greatest(l_quantity, l_quantity + 3 - CAST(round(l_tax * 100) AS INTEGER)) AS upper_bound FROM lineitem""",
)
def clamp_bounds(spark, sf):
    point = F.col("l_quantity")
    crossing = i.table(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("horizon"),
        point.alias("point_prediction"),
        (point + F.round(F.col("l_discount") * 100).cast("int") - 7).alias("lower_bound"),
        (point + 3 - F.round(F.col("l_tax") * 100).cast("int")).alias("upper_bound"),
    )
    return crossing.withColumns(errors.clamp_bounds("point_prediction", "lower_bound", "upper_bound"))


PRED_COLUMNS = ", ".join(PREDICTION.fieldNames())


@query("format_predictions", f"{PRED} SELECT {PRED_COLUMNS} FROM predictions")
def format_predictions(spark, sf):
    shuffled = i.predictions(spark, sf).withColumn("horizon", F.col("horizon").cast("bigint"))
    return ev.format_predictions(shuffled.select(*reversed(shuffled.columns)))


@query(
    "prediction_summary",
    rounded_sql(
        PRED
        + """ SELECT CAST(count(*) AS BIGINT) AS n_predictions, min(prediction_date) AS prediction_date_start,
                max(prediction_date) AS prediction_date_end, avg(point_prediction) AS mean_prediction,
                min(point_prediction) AS min_prediction, max(point_prediction) AS max_prediction,
                stddev_samp(point_prediction) AS std_prediction, avg(upper_bound - lower_bound) AS mean_interval_width,
                quantile_cont(point_prediction, 0.5) AS median_prediction,
                quantile_cont(upper_bound - lower_bound, 0.5) AS median_interval_width FROM predictions""",
        ["mean_prediction", "std_prediction", "mean_interval_width", "median_prediction", "median_interval_width"],
    ),
)
def prediction_summary(spark, sf):
    return rounded(ev.prediction_summary(i.predictions(spark, sf)))


@query(
    "prediction_run_metadata",
    rounded_sql(
        PRED
        + """ SELECT prediction_timestamp, CAST(count(*) AS BIGINT) AS n_predictions, min(prediction_date) AS base_date,
                max(prediction_date) AS end_date, avg(point_prediction) AS mean_prediction,
                min(point_prediction) AS min_prediction, max(point_prediction) AS max_prediction,
                stddev_samp(point_prediction) AS std_prediction, avg(upper_bound - lower_bound) AS avg_interval_width
            FROM predictions GROUP BY prediction_timestamp""",
        ["mean_prediction", "std_prediction", "avg_interval_width"],
    ),
)
def prediction_run_metadata(spark, sf):
    return rounded(ev.run_metadata(i.predictions(spark, sf)))


@query(
    "prediction_extremes",
    rounded_sql(
        PRED
        + """ SELECT series, avg(point_prediction) AS mean_prediction, stddev_samp(point_prediction) AS std_prediction,
                avg(upper_bound - lower_bound) AS mean_interval_width, min(point_prediction) AS min_prediction,
                first(horizon ORDER BY point_prediction, horizon) AS min_horizon, max(point_prediction) AS max_prediction,
                first(horizon ORDER BY point_prediction DESC, horizon) AS max_horizon FROM predictions GROUP BY series""",
        ["mean_prediction", "std_prediction", "mean_interval_width"],
    ),
)
def prediction_extremes(spark, sf):
    return rounded(ev.prediction_extremes(i.predictions(spark, sf), S))


@query(
    "predictions_per_horizon",
    PRED + " SELECT horizon, CAST(count(*) AS BIGINT) AS n_predictions FROM predictions GROUP BY horizon",
)
def predictions_per_horizon(spark, sf):
    return ev.predictions_per_horizon(i.predictions(spark, sf))


@query("sort_horizon", f"{PRED} SELECT * FROM predictions ORDER BY horizon, prediction_date, prediction_timestamp")
def sort_horizon(spark, sf):
    return ev.sort_predictions(i.predictions(spark, sf), "horizon")


@query("sort_prediction_date", f"{PRED} SELECT * FROM predictions ORDER BY prediction_date, horizon")
def sort_prediction_date(spark, sf):
    return ev.sort_predictions(i.predictions(spark, sf), "prediction_date")


@query(
    "union_horizons",
    PRED + " SELECT series, prediction_date, horizon, point_prediction FROM predictions",
)
def union_horizons(spark, sf):
    """Tables of single horizons, each with its own columns, in one."""
    made = i.predictions(spark, sf).select("series", "prediction_date", "horizon", "point_prediction")
    parts = {h: made.where(F.col("horizon") == h).drop("horizon") for h in range(1, 8)}
    return shape.union_horizons(parts).select(*made.columns)


BROKEN_SQL = """broken AS (SELECT prediction_timestamp, prediction_date,
    CAST(CASE WHEN day(prediction_date) = 3 THEN horizon + 7 ELSE horizon END AS INTEGER) AS horizon,
    CASE WHEN day(prediction_date) = 5 THEN NULL ELSE model_version END AS model_version, point_prediction,
    CASE WHEN day(prediction_date) = 9 THEN upper_bound + 1 ELSE lower_bound END AS lower_bound, upper_bound FROM predictions)"""


def _broken(spark, sf):
    day = F.dayofmonth("prediction_date")
    return i.predictions(spark, sf).withColumns(
        {
            "horizon": F.when(day == 3, F.col("horizon") + 7).otherwise(F.col("horizon")),
            "model_version": F.when(day != 5, F.col("model_version")),
            "lower_bound": F.when(day == 9, F.col("upper_bound") + 1).otherwise(F.col("lower_bound")),
        }
    )


@query(
    "validate_predictions",
    with_ctes(i.DAILY, i.PREDICTIONS, BROKEN_SQL)
    + """ SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (model_version IS NULL) AS BIGINT) AS n_null,
            CAST(count(*) FILTER (horizon NOT BETWEEN 1 AND 7) AS BIGINT) AS n_bad_horizon,
            CAST(count(*) FILTER (lower_bound > point_prediction OR point_prediction > upper_bound) AS BIGINT) AS n_bad_bounds
        FROM broken""",
)
def validate_predictions(spark, sf):
    return validate.prediction_rules(_broken(spark, sf))


@query(
    "table_contracts",
    with_ctes(i.DAILY, i.PREDICTIONS, BROKEN_SQL)
    + f" SELECT {PRED_COLUMNS} FROM broken WHERE model_version IS NOT NULL AND horizon BETWEEN 1 AND 7",
)
def table_contracts(spark, sf):
    return validate.within_contract(_broken(spark, sf).select(*PREDICTION.fieldNames()), PREDICTION)


@query(
    "contract_violations",
    rounded_sql(
        SCORES
        + f""", m AS (SELECT horizon, {METRICS_SQL} FROM scores GROUP BY horizon)
            SELECT DATE '2001-08-02' AS evaluation_date, 'v1' AS model_version, CAST(horizon + 3 AS INTEGER) AS horizon,
                   mae, rmse, coverage, interval_width FROM m WHERE horizon + 3 > 7""",
        METRIC_NAMES,
    ),
)
def contract_violations(spark, sf):
    rows = ev.metrics_by_horizon(i.scores(spark, sf)).select(
        F.lit(AS_OF).alias("evaluation_date"),
        F.lit("v1").alias("model_version"),
        (F.col("horizon") + 3).alias("horizon"),
        *METRIC_NAMES,
    )
    return rounded(validate.contract_violations(rows, MODEL_PERFORMANCE))


@query(
    "validate_freshness",
    with_ctes(i.DAILY)
    + """ SELECT series, max("Date") AS last_date, CAST(count(*) AS BIGINT) AS n_rows,
            CAST(DATE '2001-08-02' - max("Date") AS INTEGER) AS staleness_days,
            DATE '2001-08-02' - max("Date") > 1 AS too_stale, count(*) < 60 AS too_few_rows FROM daily GROUP BY series""",
)
def validate_freshness(spark, sf):
    return validate.freshness(i.daily(spark, sf), AS_OF, series_cols=S)


@query(
    "check_freshness",
    with_ctes(i.DAILY)
    + """ SELECT series, CAST(DATE '2001-08-08' - max("Date") AS INTEGER) AS age_days,
            DATE '2001-08-08' - max("Date") <= 7 AS is_fresh FROM daily GROUP BY series""",
)
def check_freshness(spark, sf):
    return validate.check_freshness(i.daily(spark, sf), dt.date(2001, 8, 8), series_cols=S)


@query(
    "metric_rows",
    SCORES
    + """, m AS (SELECT horizon, CAST(count(*) AS VARCHAR) AS n_rows,
            CAST(count(*) FILTER (actual > predicted) AS VARCHAR) AS n_under,
            CAST(CAST(max(actual) AS BIGINT) AS VARCHAR) AS highest FROM scores GROUP BY horizon)
       SELECT horizon, metric, value FROM (UNPIVOT m ON n_rows, n_under, highest INTO NAME metric VALUE value)""",
)
def metric_rows_query(spark, sf):
    wide = i.scores(spark, sf).groupBy("horizon").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("actual") > F.col("predicted")).alias("n_under"),
        F.max("actual").cast("bigint").alias("highest"),
        F.array(F.lit(1)).alias("skipped"),
    )
    return metric_rows(wide, ["horizon"])


@query(
    "flatten_params",
    """SELECT event_id AS "run", event_type AS "params.kind", value AS "params.tree.rate",
          user_id AS "params.tree.depth" FROM events""",
)
def flatten_query(spark, sf):
    tree = F.struct(F.col("value").alias("rate"), F.col("user_id").alias("depth"))
    nested = i.table(spark, sf, "events").select(
        F.col("event_id").alias("run"), F.struct(F.col("event_type").alias("kind"), tree.alias("tree")).alias("params")
    )
    return flatten_params(nested)


@query(
    "math_basics",
    rounded_sql(
        SCORES
        + """ SELECT horizon, sum(abs(actual - predicted)) AS total_abs, avg((actual - predicted) * (actual - predicted)) AS mse,
              CAST(sum(trunc(greatest(0, actual - predicted) / 2)) AS BIGINT) AS half_excess,
              100 * avg(actual / nullif(predicted, 0)) AS ratio_pct FROM scores GROUP BY horizon""",
        ["total_abs", "mse", "ratio_pct"],
    ),
)
def math_basics(spark, sf):
    miss = F.col("actual") - F.col("predicted")
    return rounded(
        i.scores(spark, sf).groupBy("horizon").agg(
            F.sum(F.abs(miss)).alias("total_abs"),
            F.avg(F.pow(miss, 2)).alias("mse"),
            F.sum((F.greatest(F.lit(0.0), miss) / 2).cast("bigint")).alias("half_excess"),
            (100 * F.avg(F.try_divide("actual", "predicted"))).alias("ratio_pct"),
        )
    )


@query(
    "bool_member",
    """SELECT event_id, CAST(event_type IN ('click', 'view') AS INTEGER) AS is_visit,
          CAST(value BETWEEN 10 AND 50 AS INTEGER) AS in_range FROM events""",
)
def bool_member(spark, sf):
    return i.table(spark, sf, "events").select(
        "event_id",
        F.col("event_type").isin("click", "view").cast("int").alias("is_visit"),
        F.col("value").between(10, 50).cast("int").alias("in_range"),
    )


@query(
    "text_ops",
    """SELECT c_custkey, regexp_extract(c_name, '#0*([0-9]+)$', 1) AS digits, lower(trim(c_mktsegment)) AS segment,
          replace(lower(c_name), 'customer#', '') AS suffix, regexp_matches(c_name, '^Customer#[0-9]+$') AS well_formed
       FROM customer""",
)
def text_ops(spark, sf):
    return i.table(spark, sf, "customer").select(
        "c_custkey",
        F.regexp_extract("c_name", "#0*([0-9]+)$", 1).alias("digits"),
        F.lower(F.trim("c_mktsegment")).alias("segment"),
        F.replace(F.lower("c_name"), F.lit("customer#"), F.lit("")).alias("suffix"),
        F.col("c_name").rlike("^Customer#[0-9]+$").alias("well_formed"),
    )


RESULTS_SQL = f"""m AS (SELECT horizon, {METRICS_SQL} FROM scores GROUP BY horizon),
results AS (SELECT horizon, mae, rmse, coverage, interval_width, mae < 12.8 AS promoted, n_samples AS version FROM m)"""


def _results(spark, sf):
    metrics = ev.metrics_by_horizon(i.scores(spark, sf))
    return metrics.withColumn("promoted", F.col("mae") < 12.8).withColumn("version", F.col("n_samples"))


@query(
    "training_summary",
    rounded_sql(
        with_ctes(i.SCORES, RESULTS_SQL)
        + """ SELECT horizon, mae, rmse, 100 * coverage AS coverage_pct, interval_width,
               CASE WHEN promoted THEN 'Yes' ELSE 'No' END AS promoted, version FROM results""",
        ["mae", "rmse", "coverage_pct", "interval_width"],
    ),
)
def training_summary(spark, sf):
    return rounded(ev.training_summary(_results(spark, sf)))


@query(
    "flow_totals",
    rounded_sql(
        with_ctes(i.SCORES, RESULTS_SQL, i.REGISTRY)
        + """, ranked AS (SELECT stage, row_number() OVER (PARTITION BY model_name ORDER BY version DESC) AS rn FROM registry)
             SELECT CAST(count(*) AS BIGINT) AS models_trained, CAST(count(*) FILTER (promoted) AS BIGINT) AS models_promoted,
               (SELECT CAST(count(*) AS BIGINT) FROM ranked WHERE rn > 52 AND stage IN ('None', 'Staging')) AS models_archived,
               avg(mae) AS mean_mae FROM results""",
        ["mean_mae"],
    ),
)
def flow_totals(spark, sf):
    return rounded(ev.flow_totals(_results(spark, sf), newly_archived(i.registry(spark, sf))))
