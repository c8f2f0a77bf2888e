import pytest

from daymark.operators import registry as reg
from daymark.plans.training import RESULTS, empty_registry, register_and_promote
from daymark.schema import REGISTRY


def table(spark, rows):
    full = [(name, v, stage, tags, None, f"p{v}") for name, v, stage, tags in rows]
    return spark.createDataFrame(full, REGISTRY)


def stages(df):
    return {(r.model_name, r.version): r.stage for r in df.collect()}


def test_lookup_of_the_production_version(spark):
    registry = table(spark, [("m", 1, "Production", {}), ("m", 2, "Production", {}), ("m", 3, "None", {})])
    names = spark.createDataFrame([("m",), ("other",)], "model_name string")
    found = {r.model_name: r.model_version for r in reg.model_version_lookup(names, registry).collect()}
    assert found == {"m": "2", "other": "unknown"}
    assert {r.model_name: r.path for r in reg.model_paths(names, registry).collect()} == {"m": "p2", "other": None}
    assert reg.model_paths(names, registry, version=3).where("model_name = 'm'").first().path == "p3"


@pytest.mark.parametrize(
    "tags, baseline",
    [({"mae": "5.5"}, 5.5), ({"mae": "", "test_mae": "6"}, 6.0), ({"other": "1"}, None), ({"mae": "n/a"}, None)],
)
def test_baseline(spark, tags, baseline):
    candidates = spark.createDataFrame([("m", 4.0)], "model_name string, mae double")
    registry = table(spark, [("m", 1, "Production", tags)])
    assert reg.candidate_vs_baseline(candidates, registry).first().baseline_mae == baseline


@pytest.mark.parametrize(
    "mae, baseline, either, both",
    [(10.0, None, True, False), (16.0, None, False, False), (16.0, 17.0, True, False), (10.0, 9.0, True, False), (8.0, 9.0, True, True), (15.0, 15.0, False, False)],
)
def test_promotion(spark, mae, baseline, either, both):
    df = spark.createDataFrame([(mae, baseline)], "mae double, baseline_mae double")
    assert reg.promotion_decision(df).first().promoted is either
    assert reg.promotion_decision(df, require_both=True).first().promoted is both


def test_promote_archives_the_old_production(spark):
    registry = table(spark, [("m", 1, "Production", {}), ("m", 2, "None", {}), ("n", 1, "Production", {})])
    chosen = spark.createDataFrame([("m", 2)], "model_name string, version bigint")
    assert stages(reg.promote(registry, chosen)) == {("m", 1): "Archived", ("m", 2): "Production", ("n", 1): "Production"}
    assert stages(reg.promote(registry, chosen, archive_existing=False))["m", 1] == "Production"


def test_retention_counts_versions_of_all_stages(spark):
    rows = [("m", v, "Production" if v in (2, 9) else "None", {}) for v in range(1, 11)]
    kept = stages(reg.keep_latest_versions(table(spark, rows), keep_n=3))
    assert {v for (_, v), s in kept.items() if s == "Archived"} == {1, 3, 4, 5, 6, 7}
    assert kept["m", 2] == "Production"
    assert set(stages(reg.keep_latest_versions(table(spark, rows), keep_n=0)).values()) == {"Archived", "Production"}


def test_delete_and_describe(spark):
    registry = table(spark, [("m", 1, "None", {}), ("m", 2, "None", {})])
    one = spark.createDataFrame([("m", 1, "good")], "model_name string, version bigint, description string")
    assert set(stages(reg.delete_versions(registry, one))) == {("m", 2)}
    assert {r.version: r.description for r in reg.set_descriptions(registry, one).collect()} == {1: "good", 2: None}


def test_register_and_promote_twice(spark):
    def results(*maes):
        rows = [(f"f_horizon_{h}", h, mae, mae, 0.9, 5.0, f"run/{h}") for h, mae in enumerate(maes, 1)]
        return spark.createDataFrame(rows, RESULTS)

    registry, decided = register_and_promote(empty_registry(spark), results(10.0, 20.0))
    assert {r.horizon: r.promoted for r in decided.collect()} == {1: True, 2: False}
    registry, decided = register_and_promote(registry, results(9.0, 19.0))
    assert {r.horizon: r.baseline_mae for r in decided.collect()} == {1: 10.0, 2: None}
    assert stages(registry) == {
        ("f_horizon_1", 1): "Archived",
        ("f_horizon_1", 2): "Production",
        ("f_horizon_2", 1): "None",
        ("f_horizon_2", 2): "None",
    }
