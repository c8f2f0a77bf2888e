import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daymark.functions.quantiles import exact_quantiles, histogram_quantile

PROBS = [0.0, 0.025, 0.25, 0.5, 0.95, 1.0]
NAMES = [f"q{i}" for i in range(len(PROBS))]
WANTED = {name: ("v", p) for name, p in zip(NAMES, PROBS)}
MEDIAN = {"p50": ("v", 0.5)}


def check(spark, groups, **options):
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    out = {r.g: r for r in exact_quantiles(df, WANTED, ["g"], carry={"n": F.count("v")}, **options).collect()}
    for g, vs in groups.items():
        assert out[g].n == len(vs)
        assert [out[g][n] for n in NAMES] == pytest.approx(np.quantile(vs, PROBS).tolist(), abs=1e-9)


def test_one_group_with_most_rows_and_many_ties(spark):
    rng = random.Random(3)
    check(
        spark,
        {
            "hot": [rng.choice([1, 1, 1, 2, 5, 9]) for _ in range(20000)],
            "smooth": [rng.gauss(0, 1) for _ in range(5000)],
            "single": [4.0],
            "pair": [1.0, 2.0],
        },
        few_groups=True,
    )


@pytest.mark.parametrize("accuracy", [20, 100, 1000])
def test_exact_whatever_the_sketch_accuracy(spark, accuracy):
    rng = random.Random(accuracy)
    groups = {"a": [rng.random() for _ in range(3000)], "b": [rng.randint(0, 3) for _ in range(777)], "c": list(range(11))}
    check(spark, groups, accuracy=accuracy)


def test_large_and_small_groups_side_by_side(spark):
    rng = random.Random(5)
    groups = {"hot": [rng.gauss(0, 1) for _ in range(9000)], "ties": [rng.choice([1, 2]) for _ in range(501)], "edge": list(range(500))}
    check(spark, groups | {f"g{i}": [rng.random() for _ in range(i)] for i in range(1, 9)}, accuracy=100, large_group=500)


def test_rows_are_not_dealt_by_group(spark):
    """Only brackets of large groups, counted stretches and values of small groups are shuffled, whatever Spark thinks of sizes."""
    df = spark.range(30_000).selectExpr("id % 3 AS g", "CAST(id * 7919 % 30011 AS DOUBLE) AS v")
    adaptive, limit = (f"spark.sql.{name}" for name in ("adaptive.enabled", "autoBroadcastJoinThreshold"))
    old = {name: spark.conf.get(name) for name in (adaptive, limit)}
    spark.conf.set(adaptive, "false")
    spark.conf.set(limit, "-1")
    try:
        found = exact_quantiles(df, MEDIAN, ["g"], accuracy=1000, large_group=1000)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        medians = {r.g: r.p50 for r in found.collect()}
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    expected = {g: float(np.median([i * 7919 % 30011 for i in range(g, 30_000, 3)])) for g in range(3)}
    assert medians == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40))
def test_any_small_group(spark, vs):
    check(spark, {"g": vs}, accuracy=50)


def test_nulls_are_left_out_and_whole_table_is_one_group(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    row = exact_quantiles(df, MEDIAN, carry={"n": F.count("v")}).first()
    assert (row.n, row.p50) == (2, 2.0)


def test_null_group_keys_stay(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("x", 5.0)], "g string, v double")
    out = {r.g: r.p50 for r in exact_quantiles(df, MEDIAN, ["g"]).collect()}
    assert out == {None: 2.0, "x": 5.0}


def test_histogram_quantile(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.5, 1.6, 1.7, 9.0)], "v double")
    row = histogram_quantile(df, "v", [1, 2, 5], [0.5, 0.9]).first()
    # rank 2.5 lies in (1, 2] after one value of four: 1 + 1.5 / 3; rank 4.5 is beyond the last edge.
    assert (row.p50, row.p90) == (pytest.approx(1.5), 5.0)


def test_two_columns_in_one_go(spark):
    df = spark.createDataFrame([("a", 1.0, 10.0), ("a", 3.0, None), ("b", None, 7.0)], "g string, v double, w double")
    out = {r.g: (r.mv, r.mw, r.n) for r in exact_quantiles(
        df, {"mv": ("v", 0.5), "mw": ("w", 0.5)}, ["g"], carry={"n": F.count("*")}
    ).collect()}
    assert out == {"a": (2.0, 10.0, 2), "b": (None, 7.0, 1)}
