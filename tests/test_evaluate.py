import datetime as dt

import pytest
from pyspark.sql import Row

from daymark.functions import errors
from daymark.functions.shape import flatten_params, metric_rows, union_horizons
from daymark.operators import evaluate as ev
from daymark.operators import validate
from daymark.schema import PREDICTION
from tests.test_sources import predictions  # noqa: F401

SCORED = "actual double, predicted double, lower_bound double, upper_bound double"


@pytest.fixture
def scored(spark):
    rows = [(10.0, 12.0, 8.0, 16.0), (20.0, 18.0, 14.0, 22.0), (30.0, 32.0, 28.0, 36.0), (40.0, 38.0, 34.0, 42.0)]
    return spark.createDataFrame(rows, SCORED)


def test_metrics(scored):
    row = ev.evaluate(scored).first()
    assert tuple(row) == (2.0, 2.0, 4, 1.0, 8.0)
    assert ev.evaluate(scored.drop("lower_bound")).columns == ["mae", "rmse", "n_samples"]
    rows = ev.error_rows(scored).collect()
    assert [(r.error, r.abs_error) for r in rows] == [(-2, 2), (2, 2), (-2, 2), (2, 2)]


def test_coverage_counts_the_bounds_themselves(spark):
    rows = [(5.0, 5.0, 5.0, 5.0), (4.9, 5.0, 5.0, 6.0)]
    assert ev.evaluate(spark.createDataFrame(rows, SCORED)).first().coverage == 0.5


def test_mape(spark):
    zeros = spark.createDataFrame([(0.0, 1.0)] * 3, "a double, p double")
    assert zeros.agg(errors.mape("a", "p").alias("m")).first().m == 100.0
    negative = spark.createDataFrame([(-1.0, 1.0), (1.0, 3.0)], "a double, p double")
    assert negative.agg(errors.mape("a", "p").alias("m")).first().m == 100.0  # a division by zero is left out


def test_clamp(spark):
    rows = [(10.0, 12.0, 8.0), (10.0, 9.0, 11.0)]
    df = spark.createDataFrame(rows, "p double, l double, u double")
    out = [tuple(r) for r in df.withColumns(errors.clamp_bounds("p", "l", "u")).collect()]
    assert out == [(10.0, 10.0, 10.0), (10.0, 9.0, 11.0)]


def test_calibration_widens_to_the_wanted_coverage(spark):
    rows = [(float(i), 0.0, -10.0, 10.0) for i in range(101)]
    df = spark.createDataFrame(rows, SCORED)
    factor = ev.conformal_calibration(df, alpha=0.05).first()
    assert (factor.residual_quantile, factor.correction_factor) == (95.0, 9.5)
    assert ev.evaluate(ev.widen(df, factor.correction_factor)).first().coverage >= 0.95


def test_prediction_summary(predictions):  # noqa: F811
    row = ev.prediction_summary(predictions).first()
    assert (row.n_predictions, row.min_prediction, row.max_prediction) == (7, 61.0, 67.0)
    assert (row.median_prediction, row.mean_interval_width, row.median_interval_width) == (64.0, 20.0, 20.0)
    assert row.prediction_date_start == dt.date(2025, 10, 2)
    extremes = ev.prediction_extremes(predictions).first()
    assert (extremes.min_horizon, extremes.max_horizon) == (1, 7)
    assert ev.predictions_per_horizon(predictions).count() == 7
    assert [r.horizon for r in ev.sort_predictions(predictions).collect()] == list(range(1, 8))


def test_format(predictions):  # noqa: F811
    mixed = predictions.selectExpr("*", "1 AS extra").withColumn("horizon", predictions.horizon.cast("string"))
    out = ev.format_predictions(mixed.select(*reversed(mixed.columns)))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in PREDICTION]


def test_validate_predictions(spark, predictions):  # noqa: F811
    assert validate.validate_predictions(predictions) is True
    equal = predictions.withColumn("lower_bound", predictions.point_prediction)
    assert validate.validate_predictions(equal) is True
    from pyspark.sql import functions as F

    wrong = [
        predictions.drop("model_version"),
        predictions.withColumn("prediction_date", F.lit(None).cast("date")),
        predictions.withColumn("point_prediction", F.lit(float("nan"))),
        predictions.withColumn("horizon", F.lit(8)),
        predictions.withColumn("lower_bound", F.col("point_prediction") + 5),
    ]
    for df in wrong:
        with pytest.raises(ValueError):
            validate.validate_predictions(df)
    assert validate.contract_violations(wrong[3], PREDICTION).count() == 7
    assert validate.within_contract(wrong[3], PREDICTION).count() == 0


def test_freshness(daily):
    df = daily("2025-01-01", [1] * 70)
    last = dt.date(2025, 3, 11)
    assert validate.require_fresh(df, last + dt.timedelta(days=1)) is df
    with pytest.raises(ValueError):
        validate.require_fresh(df, last + dt.timedelta(days=2))
    with pytest.raises(ValueError):
        validate.require_fresh(df.limit(10), last, max_staleness_days=999)
    with pytest.raises(ValueError):
        validate.require_fresh(df.where("false"), last)
    assert validate.check_freshness(df, last + dt.timedelta(days=7)).first().is_fresh
    assert not validate.check_freshness(df, last + dt.timedelta(days=8)).first().is_fresh


def test_training_summary(spark):
    kinds = "horizon int, mae double, rmse double, coverage double, interval_width double, promoted boolean, version bigint"
    df = spark.createDataFrame([(2, 8.0, 9.0, 0.5, 4.0, False, 3), (1, 6.0, 7.0, None, None, True, 4)], kinds)
    rows = ev.training_summary(df).collect()
    assert [(r.horizon, r.coverage_pct, r.promoted) for r in rows] == [(1, None, "Yes"), (2, 50.0, "No")]
    totals = ev.flow_totals(df).first()
    assert tuple(totals) == (2, 1, 0, 7.0)


def test_union_horizons(spark):
    parts = {2: spark.sql("SELECT 1 AS a, 9 AS horizon"), 1: spark.sql("SELECT 2 AS b, 3 AS a UNION ALL SELECT 2, 3")}
    rows = union_horizons(parts).select("horizon", "a", "b").collect()
    assert sorted(map(str, rows)) == sorted(map(str, [Row(horizon=1, a=3, b=2)] * 2 + [Row(horizon=2, a=1, b=None)]))
    with pytest.raises(ValueError):
        union_horizons({})


def test_shapes(spark):
    nested = spark.sql("SELECT 1 AS a, struct(2 AS b, struct('x' AS c) AS d) AS s")
    assert flatten_params(nested).columns == ["a", "s.b", "s.d.c"]
    rows = metric_rows(spark.sql("SELECT 'k' AS key, 1 AS n, 'ok' AS status, array(1) AS skipped"), ["key"]).collect()
    assert {(r.key, r.metric, r.value) for r in rows} == {("k", "n", "1"), ("k", "status", "ok")}
