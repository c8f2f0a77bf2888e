import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest

from daymark.operators import fill
from tests.conftest import values


def frame(spark, rows):
    first = dt.date(2022, 1, 1)
    table = [(s, first + dt.timedelta(days=i), v) for s, vs in rows.items() for i, v in enumerate(vs)]
    random.Random(1).shuffle(table)
    return spark.createDataFrame(table, "series string, Date date, x double")


CASES = {
    "leading": [None, None, 3.0, 4.0],
    "inner": [1.0, None, None, 7.0],
    "trailing": [1.0, 2.0, None, None],
    "none": [None, None, None],
    "nan": [1.0, float("nan"), 3.0],
}


def test_last_known(spark):
    out = fill.fill_last_known(frame(spark, CASES), ["x"], ["series"])
    got = {s: values(out.where(f"series = '{s}'"), "x") for s in CASES}
    assert got == {
        "leading": [3, 3, 3, 4],
        "inner": [1, 1, 1, 7],
        "trailing": [1, 2, 2, 2],
        "none": [0, 0, 0],
        "nan": [1, 1, 3],
    }


def test_linear(spark):
    out = fill.fill_linear(frame(spark, CASES), ["x"], ["series"])
    got = {s: values(out.where(f"series = '{s}'"), "x") for s in CASES}
    assert got == {
        "leading": [3, 3, 3, 4],
        "inner": [1, 3, 5, 7],
        "trailing": [1, 2, 2, 2],
        "none": [0, 0, 0],
        "nan": [1, 2, 3],
    }


def test_zero(spark):
    assert values(fill.fill_zero(frame(spark, {"a": [None, 2.0]}), ["x"]), "x") == [0, 2]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_same_as_pandas_on_random_series(spark, seed):
    rng = random.Random(seed)
    x = [rng.uniform(0, 10) if rng.random() < 0.4 else None for _ in range(80)]
    df = frame(spark, {"a": x})
    s = pd.Series([np.nan if v is None else v for v in x])
    assert values(fill.fill_last_known(df, ["x"]), "x") == pytest.approx(s.ffill().bfill().fillna(0).tolist())
    linear = s.interpolate(method="linear").bfill().ffill().fillna(0)
    assert values(fill.fill_linear(df, ["x"]), "x") == pytest.approx(linear.tolist())


def test_no_frame_runs_to_the_end_of_the_partition(spark):
    plan = fill.fill_last_known(frame(spark, CASES), ["x"], ["series"])._jdf.queryExecution().toString()
    assert "unboundedfollowing" not in plan
