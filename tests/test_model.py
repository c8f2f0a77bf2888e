import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.ml import boosting, params
from daymark.ml.model import ForecastModel, add_scores, score_by_horizon
from daymark.ml.train import hyperparameter_search, train_horizon
from daymark.operators.evaluate import evaluate
from daymark.plans.prediction import load_models, predict_flow, production_version
from daymark.plans.tracking import backtest
from daymark.plans.training import empty_registry, train_flow, training_table
from tests.test_features import weather_for

FEATURES = ["feature_1", "feature_2", "feature_3", "feature_4"]
SMALL = {**params.DEFAULT_PARAMS, "n_estimators": 10, "max_depth": 4, "min_child_samples": 5}


@pytest.fixture(scope="module")
def frames(spark):
    rng = random.Random(42)
    rows = []
    for _ in range(800):
        f = [rng.gauss(0, 1) * 5, rng.gauss(0, 1) * 3, rng.gauss(0, 1), float(rng.randint(0, 4))]
        rows.append((*f, 50 + 2 * f[0] - 1.5 * f[1] + 0.3 * f[2] + rng.gauss(0, 5)))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*FEATURES, "target"])).coalesce(1)
    return df.limit(600).persist(), df.offset(600).persist()


def scored(model, df):
    return model.predict(df, True).withColumnsRenamed({"target": "actual", "point_prediction": "predicted"})


@pytest.fixture(scope="module")
def fitted(frames):
    train, _ = frames
    model = ForecastModel(FEATURES, 1).fit_point(train, SMALL)
    return model.fit_quantiles(train, {**SMALL, "learning_rate": 0.3}, rounds=12)


def test_interval(fitted, frames):
    out = scored(fitted, frames[1])
    assert out.where("lower_bound > predicted OR upper_bound < predicted").count() == 0
    row = evaluate(out).first()
    assert 0.70 <= row.coverage <= 1.0
    assert row.mae < 8


def test_quantile_trees_approach_the_quantile(fitted, frames):
    train, _ = frames
    scored = add_scores(train, FEATURES, {"low": fitted.lower, "high": fitted.upper})
    low, high = (scored.where(f"target < {q}").count() / train.count() for q in ("low", "high"))
    assert low < 0.10 and high > 0.90


def test_feature_order_does_not_matter(fitted, frames):
    row = frames[1].limit(1)
    assert fitted.predict(row).first().point_prediction == fitted.predict(row.select(*reversed(row.columns))).first().point_prediction


def test_save_and_load(spark, fitted, frames, tmp_path):
    path = fitted.save(spark, str(tmp_path / "m"))
    again = ForecastModel.load(spark, path)
    names = ["point_prediction", "lower_bound", "upper_bound"]
    assert again.predict(frames[1], True).select(*names).collect() == fitted.predict(frames[1], True).select(*names).collect()
    assert again.horizon == 1 and again.features == FEATURES
    with pytest.raises(FileNotFoundError):
        ForecastModel.load(spark, str(tmp_path / "none"))


def test_importance(spark, fitted):
    rows = fitted.feature_importance(spark, 2).collect()
    assert [r.feature for r in rows] == ["feature_1", "feature_2"]


def test_unfitted(spark, frames, tmp_path):
    empty = ForecastModel(FEATURES, 1)
    for call in (lambda: empty.predict(frames[0]), lambda: empty.feature_importance(spark), lambda: empty.save(spark, "x")):
        with pytest.raises(ValueError):
            call()
    point_only = ForecastModel(FEATURES, 1).fit_point(frames[0], {**SMALL, "n_estimators": 1})
    assert "lower_bound" not in point_only.predict(frames[1], return_intervals=True).columns


def test_params():
    p = params.checked_params({})
    assert (p["n_estimators"], p["max_depth"], p["learning_rate"], p["min_child_samples"], params.MAX_BINS) == (100, 6, 0.1, 20, 255)
    table = params.trials(50)
    assert table == params.trials(50)
    for row in table:
        for name, (_, low, high, _) in params.SEARCH_SPACE.items():
            assert low - 1e-9 <= row[name] <= high + 1e-9
    for wrong in ({"max_depth": 0}, {"subsample": 0.0}, {"learning_rate": -1.0}, {"reg_alpha": -1.0}):
        with pytest.raises(ValueError):
            params.checked_params(wrong)


def test_search_survives_a_failing_trial(frames):
    train, val = frames
    table = [{**SMALL, "n_estimators": 1}, {**SMALL, "max_depth": 99}, {**SMALL, "n_estimators": 8}]
    found = hyperparameter_search(train, val, FEATURES, 1, table)
    assert found[0]["trial"] == 2
    assert found[-1]["trial"] == 1 and found[-1]["error"]
    assert found[0]["val_mae"] <= found[1]["val_mae"]


def test_flow_from_series_to_tracked_predictions(spark, daily, year_of_counts, tmp_path):
    n = 240
    df, weather = daily("2024-01-01", year_of_counts(n)), weather_for(spark, "2024-01-01", n)
    last = dt.date(2024, 1, 1) + dt.timedelta(days=n - 1)
    options = {"table": [{**SMALL, "n_estimators": 3}], "bounds": "residual"}
    flow = train_flow(df, weather, empty_registry(spark), str(tmp_path), "run1", threshold=100.0, **options)
    assert [r.horizon for r in flow["summary"].collect()] == list(range(1, 8))
    totals = flow["totals"].first()
    assert totals.models_trained == 7 and totals.models_promoted == 7
    models = load_models(spark, flow["registry"])
    assert production_version(spark, flow["registry"]) == "1"
    with pytest.raises(ValueError):
        load_models(spark, empty_registry(spark))
    assert len(load_models(spark, empty_registry(spark), [2], {2: f"{tmp_path}/run1/horizon_2"})) == 1

    forecast = weather_for(spark, "2024-08-01", 60)
    run = predict_flow(df, weather, forecast, models, dt.datetime.combine(last, dt.time(6)), "1")
    rows = run["predictions"].orderBy("horizon").collect()
    assert [r.prediction_date for r in rows] == [last + dt.timedelta(days=h) for h in range(1, 8)]
    assert all(r.lower_bound <= r.point_prediction <= r.upper_bound for r in rows)
    assert run["summary"].first().n_predictions == 7
    with pytest.raises(ValueError):
        predict_flow(df, weather, None, models, dt.datetime(2025, 1, 1))
    partial = score_by_horizon(training_table(df, weather), {1: models[1]})
    assert {r.horizon for r in partial.select("horizon").distinct().collect()} == {1}

    tested = backtest(training_table(df, weather), models)
    assert tested["metrics"].count() == 7
    sizes = {r.horizon: r.n_samples for r in tested["metrics"].collect()}
    for h in range(1, 8):
        rows_h = n - 28 - 2 * h
        assert sizes[h] == rows_h - int(0.6 * rows_h) - 2 * int(0.1 * rows_h)


def test_train_horizon_metadata(spark, daily, year_of_counts):
    df = daily("2024-01-01", year_of_counts(160))
    from daymark.operators.clean import drop_null_rows
    from daymark.operators.features import engineer_features

    rows = drop_null_rows(engineer_features(df))
    done = train_horizon(rows, 2, table=[{**SMALL, "n_estimators": 2}], bounds="quantile", quantile_rounds=2)
    meta = done.metadata
    assert meta["n_features"] == 28
    assert meta["n_train"] + meta["n_val"] + meta["n_calib"] + meta["n_test"] == 160 - 28 - 2
    assert meta["best_val_mae"] > 0 and meta["test_interval_width"] >= 0


def test_fits_do_not_depend_on_partitions(frames):
    train, test = frames
    one = ForecastModel(FEATURES, 1).fit_point(train, SMALL).predict(test)
    two = ForecastModel(FEATURES, 1).fit_point(train.repartition(7), SMALL).predict(test)
    assert one.collect() == two.collect()


def test_short_frames_score_the_last_row(fitted, frames):
    row = frames[1].limit(1).withColumn("horizon", F.lit(3))
    out = score_by_horizon(row, {3: fitted, 7: fitted}).collect()
    assert [r.horizon for r in out] == [3, 7] and out[0].point_prediction == out[1].point_prediction


@pytest.mark.parametrize("stored", [1, 10])
def test_one_block_and_many_blocks_grow_the_same_trees(frames, monkeypatch, stored):
    """Levels inside one task and one job for each level over many blocks."""
    train, _ = frames
    own = {**SMALL, "n_estimators": 3, "max_depth": 3, "reg_lambda": 1.0, "reg_alpha": 0.5}

    def grown():
        matrix = boosting.binned(train, FEATURES, "target", quantiles=[0.9])
        models = [boosting.booster(matrix, "mean", 0, own), boosting.booster(matrix, "high", 0, own, 0.9)]
        boosting.grow(matrix, models, {"mean": 3, "high": 2})
        return matrix, models

    one, whole = grown()
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    monkeypatch.setattr(boosting, "STORED_TREES", stored)
    many, parts = grown()
    assert one.single == {0} and many.single == set() and many.blocks.count() == 6
    for a, b in zip(whole, parts):
        assert a.trees.to_lists() == b.trees.to_lists()
    errors = boosting.absolute_errors(many, parts, "train")
    assert errors == pytest.approx(boosting.absolute_errors(one, whole, "train")) and set(errors) == {"mean", "high"}


def test_growth_goes_on_where_it_stopped(frames):
    train, _ = frames
    matrix = boosting.binned(train, FEATURES, "target")
    once, twice = (boosting.booster(matrix, n, 0, SMALL) for n in ("once", "twice"))
    boosting.grow(matrix, [once], {"once": 6})
    boosting.grow(matrix, [twice], {"twice": 2})
    boosting.grow(matrix, [twice], {"twice": 6})
    assert once.trees.to_lists() == twice.trees.to_lists()


def test_parameters_take_effect(frames):
    train, _ = frames
    matrix = boosting.binned(train, FEATURES, "target")
    base = {**SMALL, "n_estimators": 2}

    def leaves(**changed):
        m = boosting.booster(matrix, "m", 0, base | changed)
        boosting.grow(matrix, [m], {"m": 2})
        return m.trees, [int((t["feature"] < 0).sum()) for t in m.trees.parts]

    plain, sizes = leaves()
    assert max(sizes) > 4
    assert max(leaves(num_leaves=4)[1]) == 4 and max(leaves(max_depth=1)[1]) == 2
    assert max(leaves(min_child_samples=400)[1]) == 1 and max(leaves(min_child_weight=400.0)[1]) == 1
    for changed in ({"reg_lambda": 50.0}, {"reg_alpha": 1e5}):
        assert np.abs(leaves(**changed)[0].parts[0]["value"]).max() < np.abs(plain.parts[0]["value"]).max()
    assert leaves(subsample=0.5)[0].to_lists() != plain.to_lists() != leaves(colsample_bytree=0.5)[0].to_lists()


def test_summaries_keep_quantiles():
    rng = np.random.default_rng(1)
    values = [rng.normal(size=5000) + k for k in range(4)]
    parts = [boosting.summary(v) for v in values]
    assert all(len(v) == boosting.SUMMARY for v, _ in parts)
    every = np.concatenate(values)
    for alpha in (0.025, 0.5, 0.975):
        assert abs((every < boosting.quantile_of(parts, alpha)).mean() - alpha) < 0.003


def test_search_stops_the_worse_half_and_goes_on_with_the_rest(frames):
    train, val = frames
    table = [{**SMALL, "n_estimators": 40, "learning_rate": r} for r in (0.001, 0.3, 0.1, 0.002)]
    found = hyperparameter_search(train, val, FEATURES, 1, table)
    assert {r["trial"] for r in found[:2]} == {1, 2} and {r["n_trees"] for r in found[2:]} == {16}
    assert found[0]["n_trees"] == 40 and found[0]["val_mae"] <= found[1]["val_mae"]


def test_search_keeps_what_stopped_a_trial(frames):
    train, val = frames
    table = [{**SMALL, "n_estimators": 40, "learning_rate": r} for r in (0.001, 0.3, 0.1, 0.002)]
    found = hyperparameter_search(train, val, FEATURES, 1, table)
    first = max(r["stopped_by"] for r in found[2:])
    assert [r["stopped_by"] for r in found[2:]] == [first] * 2 and all(first <= r["val_mae"] for r in found[2:])
    assert found[0]["stopped_by"] is None and found[1]["n_trees"] == 32 and found[1]["stopped_by"] <= found[1]["val_mae"]


def test_missing_features_and_no_rows(spark, fitted, frames):
    row = frames[1].limit(1).withColumn("feature_2", F.lit(None).cast("double"))
    assert fitted.predict(row).first().point_prediction is not None
    with pytest.raises(ValueError):
        ForecastModel(FEATURES, 1).fit_point(frames[0].limit(0), SMALL)
