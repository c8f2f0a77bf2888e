import datetime as dt

import pytest
from pyspark.sql import functions as F

from daymark.operators.evaluate import evaluate, metrics_by_horizon
from daymark.sources import predictions as pred
from daymark.sources import tables, visits

D = dt.datetime


def test_csv(spark, tmp_path):
    path = tmp_path / "visits.csv"
    path.write_text("123;2022-01-15 14:30:00\n456;2022-01-15 15:45:00;extra;data\n")
    rows = sorted(tuple(r) for r in visits.scan_visits_csv(spark, str(path)).collect())
    assert rows == [("123", D(2022, 1, 15, 14, 30)), ("456", D(2022, 1, 15, 15, 45))]


def test_csv_missing_or_empty(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        visits.scan_visits_csv(spark, str(tmp_path / "none.csv")).collect()
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError):
        visits.scan_visits_csv(spark, str(tmp_path / "empty.csv"))


LINES = [
    ")",
    "(31415, datetime.datetime(2021, 6, 7, 8, 9, 10), 'B', None, datetime.datetime(2021, 6, 7, 11, 12, 13, 140000), '2')",
    "  (7, datetime.datetime(2023, 1, 3, 13, 54, 38, 42), 'A')  ",
    "",
    "(1, datetime.datetime(2023, 2, 30, 1, 2, 3))",
    "(2, 'no time')",
    "('x', datetime.datetime(2023, 1, 3, 1, 2, 3))",
    "(3, datetime.datetime(2023, 1, 3, 1, 2), datetime.datetime(2023, 1, 4, 1, 2, 3))",
    "(4, datetime.datetime(2023, 1, 3, 1, 2, 60))",
]


def test_tuple_dump(spark, tmp_path):
    path = tmp_path / "dump.txt"
    path.write_text("\n".join(LINES))
    rows = {r.Surrogate_Key: r.Contact_Start for r in visits.scan_tuple_dump(spark, str(path)).collect()}
    assert rows == {
        "31415": D(2021, 6, 7, 8, 9, 10),
        "7": D(2023, 1, 3, 13, 54, 38, 42),
        "3": D(2023, 1, 4, 1, 2, 3),
    }


def test_tuple_dump_without_a_valid_line(spark, tmp_path):
    path = tmp_path / "dump.txt"
    path.write_text(")\n(1, 'x')\n")
    with pytest.raises(ValueError):
        visits.scan_tuple_dump(spark, str(path))
    with pytest.raises(FileNotFoundError):
        visits.scan_tuple_dump(spark, str(tmp_path / "none.txt"))


def test_first_two_columns(spark):
    df = spark.createDataFrame([(1, "2022-01-01 10:00:00", "x")], "id int, at string, other string")
    row = visits.first_two_columns(df).first()
    assert tuple(row) == ("1", D(2022, 1, 1, 10))
    with pytest.raises(ValueError):
        visits.first_two_columns(df.select("id"))


def test_database_arguments(spark):
    with pytest.raises(ValueError):
        visits.scan_visits_db(spark, "", "[x]")
    with pytest.raises(ValueError):
        visits.scan_visits_db(spark, "jdbc:none", "[a]; DROP")
    assert visits.is_bracketed_name("[db].[dbo].[T_1]")
    assert not visits.is_bracketed_name("custom")


def test_fallback_to_the_file(spark, tmp_path):
    path = tmp_path / "visits.csv"
    path.write_text("1;2022-01-15 14:30:00\n")
    assert visits.db_or_file_fallback(spark, None, str(path)).count() == 1
    broken = {"url": "jdbc:nothing://nowhere", "table": "[visits]"}
    assert visits.db_or_file_fallback(spark, broken, str(path)).count() == 1


@pytest.fixture
def predictions(spark):
    rows = [
        (D(2025, 10, 1, 6), dt.date(2025, 10, 1) + dt.timedelta(days=h), h, "3", 60.0 + h, 50.0 + h, 70.0 + h)
        for h in range(1, 8)
    ]
    kinds = (
        "prediction_timestamp timestamp_ntz, prediction_date date, horizon int, model_version string, "
        "point_prediction double, lower_bound double, upper_bound double"
    )
    return spark.createDataFrame(rows, kinds)


def test_predictions_csv_round_trip(spark, predictions, tmp_path):
    path = pred.sink_predictions_csv(predictions, str(tmp_path), run_time=D(2025, 10, 1, 6))
    assert path.endswith("predictions_20251001_060000.csv")
    again = pred.scan_predictions(spark, path)
    assert sorted(again.collect()) == sorted(predictions.collect())
    assert pred.sink_predictions_csv(predictions, str(tmp_path), False).endswith("predictions_latest.csv")


def test_predictions_csv_with_series(spark, predictions, tmp_path):
    keyed = predictions.withColumn("series", F.lit("007"))
    path = pred.sink_predictions_csv(keyed, str(tmp_path))
    again = pred.scan_predictions(spark, path, ["series"])
    assert sorted(again.select(*keyed.columns).collect()) == sorted(keyed.collect())
    with pytest.raises(Exception):  # other columns than those of the file are no silent shift
        pred.scan_predictions(spark, path).collect()


def test_predictions_table_is_idempotent(spark, predictions, tmp_path):
    path = str(tmp_path / "predictions")
    assert pred.sink_predictions_table(predictions, path) == 7
    assert pred.sink_predictions_table(predictions, path) == 0
    assert pred.sink_predictions_table(predictions, path, "replace") == 0
    assert spark.read.parquet(path).count() == 7
    with pytest.raises(ValueError):
        pred.sink_predictions_table(predictions, path, "fail")
    with pytest.raises(ValueError):
        pred.sink_predictions_table(predictions, path, "upsert")
    assert pred.sink_predictions_table(predictions.where("false"), path) == 0


def test_predictions_db_arguments(predictions):
    with pytest.raises(ValueError):
        pred.sink_predictions_db(predictions, "", "[t]")
    with pytest.raises(ValueError):
        pred.sink_predictions_db(predictions, "jdbc:x", "custom_predictions")
    with pytest.raises(ValueError):
        pred.sink_predictions_db(predictions, "jdbc:x", "[t]", "upsert")
    assert pred.sink_predictions_db(predictions.where("false"), "jdbc:x", "[t]") == 0


def test_test_predictions_are_split_by_horizon(spark, predictions, tmp_path):
    path = str(tmp_path / "test")
    pred.sink_test_predictions(predictions, path)
    assert spark.read.parquet(f"{path}/horizon=3").count() == 1
    assert spark.read.parquet(path).count() == 7


def test_run_tables(spark, predictions, tmp_path):
    scored = predictions.selectExpr("horizon", "point_prediction + 2 AS actual", "point_prediction AS predicted", "lower_bound", "upper_bound")
    assert evaluate(scored).first().mae == 2.0
    path = str(tmp_path / "performance")
    for _ in range(2):
        rows = tables.performance_rows(metrics_by_horizon(scored), "3", dt.date(2025, 10, 9), D(2025, 10, 9))
        tables.append_performance(rows, path)
    assert spark.read.parquet(path).where("horizon = 7").count() == 2
    staged = tables.sink_intermediate(scored, str(tmp_path / "stage"), ["horizon"])
    assert staged.count() == 7
    snapshot = tables.write_snapshot(scored, str(tmp_path / "state"), 1)
    assert spark.read.parquet(snapshot).count() == 7
    with pytest.raises(Exception):
        tables.write_snapshot(scored, str(tmp_path / "state"), 1)


def test_runs_are_committed_once(spark, predictions, tmp_path):
    """A run that fails leaves nothing, a repeated one replaces its own rows only."""
    path, schema = str(tmp_path / "runs"), predictions.schema
    tables.commit_run(predictions, path, "first")
    broken = predictions.withColumn("horizon", F.when(F.col("horizon") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("horizon")).cast("int"))
    with pytest.raises(Exception):
        tables.commit_run(broken.repartition(3), path, "second")
    assert tables.read_runs(spark, path, schema).count() == 7
    for _ in range(2):
        tables.commit_run(predictions.where("horizon < 4"), path, "second")
    assert tables.read_runs(spark, path, schema).count() == 10
    tables.commit_run(predictions.where("horizon = 1"), path, "first")
    found = tables.read_runs(spark, path, schema, with_run=True)
    assert {(r.run, r["count"]) for r in found.groupBy("run").count().collect()} == {("first", 1), ("second", 3)}


def test_repeated_logs(spark, predictions, tmp_path):
    for _ in range(2):
        log = tables.MetricsLog(spark, str(tmp_path / "metrics"), run_id="day1")
        log.promotion(1)
        log.promotion(1)
    assert log.read().count() == 2
    rows = predictions.select("horizon", F.lit(1.0).alias("mae"), F.lit(1.0).alias("rolling_mae"), F.lit(3).cast("bigint").alias("n_predictions"), F.col("prediction_timestamp").alias("timestamp"))
    for name in ("a", "a", "b", None):
        tables.append_tracking(rows, str(tmp_path / "log"), run_id=name)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 21


def test_params_and_metrics(spark):
    rows = tables.params_rows(spark, "r1", {"a": 1, "model": {"depth": 3, "tree": {"rate": 0.1}}}).collect()
    assert {r.name: r.value for r in rows} == {"a": "1", "model.depth": "3", "model.tree.rate": "0.1"}
    assert tables.metrics_rows(spark, "r1", {"mae": 1.5}, step=2).first().step == 2


def test_metrics_log(spark, tmp_path):
    ticks = iter(D(2025, 1, 1) + dt.timedelta(minutes=i) for i in range(100))
    log = tables.MetricsLog(spark, str(tmp_path / "metrics"), clock=lambda: next(ticks))
    log.training(1, 7.0, 9.0, 0.95, 40.0, 120.0, 10)
    log.training(1, 6.0, 8.0, 0.96, 41.0, 130.0, 10, success=False)
    log.prediction(7, 2.5, horizon_counts={1: 1, 2: 1})
    log.data_processing("load", 1000, 0.5)
    log.weather(0.2, success=False)
    log.registration(1)
    log.promotion(1)
    log.flow_status("training_flow", True)
    from daymark.operators import monitor

    metrics = log.read()
    mae = monitor.current_metric(monitor.pick(metrics, "model_mae_by_horizon", dataset="test"))
    assert (mae.first().horizon, mae.first().value) == ("1", 6.0)
    rate = monitor.success_rate(monitor.pick(metrics, "training_count_total")).first()
    assert rate.success_pct == 50.0
    defaults = {(r.metric, r.horizon, r.dataset): r.value for r in monitor.metric_defaults(metrics).collect()}
    assert defaults["model_mae_by_horizon", "1", "test"] == 6.0
    assert defaults["model_mae_by_horizon", "2", "train"] == 0.0
    flows = {r.flow_name: r.value for r in monitor.metric_defaults(metrics).where("flow_name IS NOT NULL").collect()}
    assert flows == {"training_flow": 1.0, "prediction_flow": 0.0}
