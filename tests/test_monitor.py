import datetime as dt

import pandas as pd
import pytest

from daymark.operators import monitor
from daymark.plans.tracking import track_performance

D0 = dt.date(2025, 1, 1)
KINDS = "prediction_timestamp timestamp_ntz, prediction_date date, horizon int, point_prediction double"


def predicted(spark, rows):
    return spark.createDataFrame([(dt.datetime.combine(d, dt.time()) - dt.timedelta(days=h), d, h, p) for d, h, p in rows], KINDS)


@pytest.fixture
def tables(spark):
    days = [D0 + dt.timedelta(days=i) for i in range(50)]
    predictions = predicted(spark, [(d, h, 50.0 + i * h) for i, d in enumerate(days) for h in (1, 2)])
    actuals = spark.createDataFrame([(d, 50) for d in days[:45]], "date date, patient_count bigint")
    return predictions, actuals


def test_rolling_mae_same_as_pandas(tables):
    compared = monitor.predictions_vs_actuals(*tables)
    assert compared.count() == 90
    rolled = monitor.rolling_mae(compared).where("horizon = 2").orderBy("date").collect()
    s = pd.Series([2.0 * i for i in range(45)]).rolling(30, min_periods=1)
    assert [r.rolling_mae for r in rolled] == pytest.approx(s.mean().tolist())
    assert [r.n_predictions for r in rolled] == s.count().astype(int).tolist()


def test_two_runs_for_one_date_follow_each_other(spark):
    early = predicted(spark, [(D0, 1, 10.0)])
    late = early.selectExpr("prediction_timestamp + interval 1 hour AS prediction_timestamp", "prediction_date", "horizon", "20.0D AS point_prediction")
    actuals = spark.createDataFrame([(D0, 10)], "date date, patient_count bigint")
    rolled = monitor.rolling_mae(monitor.predictions_vs_actuals(late.union(early), actuals))
    assert [r.rolling_mae for r in rolled.orderBy("prediction_timestamp").collect()] == [0.0, 5.0]
    assert monitor.latest_per_group(rolled, ["horizon"]).first().rolling_mae == 5.0


def test_tracking(spark, tables):
    last = {1: sum(range(15, 45)) / 30, 2: 2 * sum(range(15, 45)) / 30}
    baselines = spark.createDataFrame([(1, last[1] / 1.2), (2, last[2] / 1.25)], "horizon int, baseline_mae double")
    report = track_performance(*tables, baselines=baselines)
    alerts = report["alerts"].collect()
    assert [a.horizon for a in alerts] == [2]  # horizon 1 is exactly at the threshold
    assert alerts[0].degradation_percentage == pytest.approx(25.0)
    assert report["status"].first().status == "degraded"
    assert {r.horizon: r.mae for r in report["overall"].collect()} == {1: 22.0, 2: 44.0}
    assert {r.horizon: r.n_predictions for r in report["log"].collect()} == {1: 30, 2: 30}
    calm = track_performance(*tables, baselines=baselines.selectExpr("horizon", "1000.0D AS baseline_mae"))
    assert calm["status"].first().status == "healthy"
    assert "alerts" not in track_performance(*tables)


def test_no_common_days(spark, tables):
    predictions, actuals = tables
    report = track_performance(predictions, actuals.where("false"))
    assert report["rolling"].count() == 0 and report["log"].count() == 0


def metrics(spark, rows):
    table = [(dt.datetime(2025, 1, 1, h, m), name, labels, float(v)) for h, m, name, labels, v in rows]
    return spark.createDataFrame(table, monitor.RUN_METRICS)


def test_run_metrics(spark):
    rows = [
        (8, 0, "c", {"status": "success", "horizon": "1"}, 1),
        (8, 30, "c", {"status": "failure", "horizon": "1"}, 1),
        (9, 0, "c", {"status": "success", "horizon": "2"}, 2),
    ]
    df = metrics(spark, rows)
    assert monitor.success_rate(df).first().success_pct == 75.0
    assert {r.horizon: r.total for r in monitor.counter_totals(df, ["horizon"]).collect()} == {"1": 2.0, "2": 2.0}
    hourly = {r.window_start.hour: r.rate for r in monitor.counter_rate(df, per=3600).collect()}
    assert hourly == {8: 2.0, 9: 2.0}
    sliding = monitor.counter_rate(df, slide="30 minutes", per=3600)
    assert sliding.where("window_start = timestamp_ntz'2025-01-01 08:30:00'").first().rate == 3.0
    assert monitor.last_run(df, ["horizon"]).where("horizon = '1'").first().last_ts == dt.datetime(2025, 1, 1, 8, 30)
    exact = monitor.duration_quantiles(df, [0.5], ["horizon"])
    assert {r.horizon: r.p50 for r in exact.collect()} == {"1": 1.0, "2": 2.0}
    bucketed = monitor.bucketed_quantiles(df, [1, 5], [0.5], ["horizon"]).where("horizon = '2'").first()
    assert bucketed.p50 == 3.0
