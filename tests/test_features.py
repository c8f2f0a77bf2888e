import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from daymark.functions import calendar as cal
from daymark.operators import dataset, features
from daymark.operators.clean import drop_null_rows
from daymark.plans.training import training_table
from daymark.schema import WEATHER
from tests.conftest import values


def weather_for(spark, first, n):
    first = dt.date.fromisoformat(first)
    rows = [(first + dt.timedelta(days=i), 20.0 + i % 5, 5.0 + i % 3, 12.0, float(i % 4), 0.0) for i in range(n)]
    return spark.createDataFrame(rows, "Date date, " + ", ".join(f"{c} double" for c in WEATHER))


def test_weekend(daily):
    assert values(features.add_weekend(daily("2022-01-01", [1, 1, 1, 1])), "Weekend") == [1, 1, 0, 0]


def test_onehot_has_a_fixed_base_level(daily):
    out = features.add_onehot_weekday(daily("2022-01-04", [1, 1]))  # Tuesday, Wednesday
    assert values(out, "Day_of_week_1") == [1, 0]
    assert values(out, "Day_of_week_2") == [0, 1]
    assert [c for c in out.columns if c.startswith("Day_of_week")] == [f"Day_of_week_{i}" for i in range(1, 7)]


def test_cyclic_values(daily):
    row = features.add_date_features(daily("2022-03-02", [1])).first()  # a Wednesday
    assert row.Day_of_week_sin == pytest.approx(math.sin(2 * math.pi * 2 / 7))
    assert row.Month_cos == pytest.approx(math.cos(2 * math.pi * 2 / 12))
    assert row.Day_of_month_sin == pytest.approx(math.sin(2 * math.pi * 1 / 31))


def test_fourier_names_and_range(daily):
    df = daily("2022-01-01", [1] * 30)
    assert len(cal.fourier(F.lit(0))) == 14
    out = features.add_fourier(df)
    for name in cal.fourier(F.lit(0)):
        assert all(-1 <= v <= 1 for v in values(out, name))
    weekly = features.add_fourier(df, [7.0], {7.0: 1})
    assert set(weekly.columns) - set(df.columns) == {"weekly_sin_1", "weekly_cos_1"}
    anchored = features.add_fourier(df, [7.0], {7.0: 1}, anchor=dt.date(2021, 12, 31))
    assert values(anchored, "weekly_sin_1")[0] == pytest.approx(math.sin(2 * math.pi / 7))


def test_lags(daily):
    out = features.add_lags(daily("2022-01-01", [10, 20, 30, 40, 50]), [1, 2])
    assert values(out, "patients_lag_1") == [None, 10, 20, 30, 40]
    assert values(out, "patients_lag_2") == [None, None, 10, 20, 30]


def test_rolling_leaves_the_row_itself_out(daily):
    out = features.add_rolling(daily("2022-01-01", [10 * i for i in range(1, 11)]), [3])
    assert values(out, "patients_3d_avg")[3] == 20.0
    assert values(out, "patients_3d_std")[:2] == [None, None]
    assert values(features.add_rolling(daily("2022-01-01", [10, 20, 30, 40, 50]), [2]), "patients_2d_avg")[2] == 15.0


def test_changes(daily):
    df = features.add_lags(daily("2022-01-01", [i * 10 for i in range(20)]))
    assert values(features.add_changes(df), "patients_change_1d")[2] == 10
    without = features.add_lags(daily("2022-01-01", [1, 2]), [1])
    assert features.add_changes(without).columns == without.columns


@pytest.mark.parametrize("seed", [5, 6])
def test_same_as_pandas_on_random_series(daily, seed):
    rng = random.Random(seed)
    counts = [rng.randint(0, 90) for _ in range(70)]
    out = features.add_rolling(features.add_lags(daily("2022-01-01", counts)))
    s = pd.Series(counts, dtype="float64")
    for k in features.LAGS:
        assert values(out, f"patients_lag_{k}")[k:] == s.shift(k).dropna().astype(int).tolist()
    for n in features.ROLLING_WINDOWS:
        rolled = s.shift(1).rolling(n, min_periods=1)
        assert values(out, f"patients_{n}d_avg")[1:] == pytest.approx(rolled.mean().tolist()[1:])
        assert values(out, f"patients_{n}d_std")[2:] == pytest.approx(rolled.std().tolist()[2:])


def test_features_of_a_day_do_not_see_it_or_later_days(daily, year_of_counts):
    counts = year_of_counts(80)
    changed = counts[:60] + [c + 500 for c in counts[60:]]
    names = None
    rows = []
    for series in (counts, changed):
        out = features.engineer_features(daily("2022-01-01", series))
        names = features.select_features(out)
        rows.append(out.orderBy("Date").select(*names).collect()[:61])
    assert rows[0] == rows[1]
    assert len(names) == 28


def test_rows_and_calendar_days_differ_with_gaps(daily):
    df = daily("2022-01-01", [1, None, 3, 4])
    assert values(features.engineer_features(df), "patients_lag_1") == [None, 1, 3]
    strict = features.engineer_features(df, strict_calendar=True)
    assert values(strict, "patients_lag_1")[2] == values(strict, "Patients_per_day")[1]


def test_target_features_per_horizon(spark, daily):
    weather = weather_for(spark, "2022-01-01", 40)
    out = features.engineer_for_horizons(daily("2022-01-01", [5] * 40), weather)
    assert out.count() == 280
    row = out.where("Date = '2022-01-10' and horizon = 4").first()
    assert row.Temp_Max == weather.where("Date = '2022-01-14'").first().Temp_Max
    assert row.Day_of_week_4 == 1  # 2022-01-14 is a Friday
    assert out.where("Date = '2022-02-09' and horizon = 1").first().Temp_Max is None


@pytest.mark.parametrize("lossless", [False, True])
def test_row_counts_of_labelled_splits(spark, daily, lossless):
    days = 1218
    df, weather = daily("2022-05-24", [50 + i % 7 for i in range(days)]), weather_for(spark, "2022-05-24", days)
    rows = training_table(df, weather, lossless=lossless)
    split = dataset.temporal_split(rows)
    sizes = {(r.horizon, r.split): r.n_rows for r in dataset.split_sizes(split).collect()}
    for h in range(1, 8):
        n = days - 28 - (h if lossless else 2 * h)
        expected = [int(0.6 * n), int(0.1 * n), int(0.1 * n)]
        expected.append(n - sum(expected))
        assert [sizes[h, p] for p in ("train", "val", "calib", "test")] == expected
    if not lossless:
        assert [sizes[h, "test"] for h in range(1, 8)] == [240, 239, 238, 237, 236, 238, 237]
        first = split.where("split = 'test' and horizon = 1").agg(F.min("Date"), F.max("Date")).first()
        assert first[0] + dt.timedelta(days=1) == dt.date(2025, 1, 25)
        assert first[1] + dt.timedelta(days=1) == dt.date(2025, 9, 21)


def test_shifted_target(daily):
    df = daily("2022-01-01", list(range(100)))
    one = dataset.shifted_target(df, 1)
    assert one.count() == 99
    assert values(one, "target")[:3] == [1.0, 2.0, 3.0]
    assert dataset.shifted_target(df, 7).count() == 93
    for wrong in (0, 8):
        with pytest.raises(ValueError):
            dataset.shifted_target(df, wrong)
    with pytest.raises(KeyError):
        dataset.shifted_target(df.drop("Patients_per_day"), 1)


def test_temporal_split(daily):
    split = dataset.temporal_split(daily("2022-01-01", [1] * 100))
    assert values(split, "split") == ["train"] * 60 + ["val"] * 10 + ["calib"] * 10 + ["test"] * 20
    with pytest.raises(ValueError):
        dataset.temporal_split(split, {"train": 0.5, "test": 0.4})


def test_future_rows(spark, daily):
    n = 60
    history = features.engineer_features(daily("2025-08-02", [40 + i % 7 for i in range(n)]))
    history = history.join(weather_for(spark, "2025-08-02", n), "Date", "left")
    last = dt.date(2025, 9, 30)
    future = features.future_features(drop_null_rows(history))
    assert values(future, "Date", "horizon") == [last + dt.timedelta(days=h) for h in range(1, 8)]
    assert set(values(future, "patients_lag_1", "horizon")) == {history.where(F.col("Date") == last).first().patients_lag_1}
    assert values(future, "Weekend", "horizon") == [0, 0, 0, 1, 1, 0, 0]
    based = features.horizon_expand(history, dt.date(2025, 10, 5))
    assert values(based, "Date", "horizon")[0] == dt.date(2025, 10, 6)


def test_forecast_row_wins_even_with_a_null(spark, daily):
    from daymark.operators.weather import forecast_at_horizon

    state = daily("2025-09-30", [5]).join(weather_for(spark, "2025-09-30", 1), "Date")
    rows = [(dt.date(2025, 10, 1), 1.0, None, 0.5, 0.0, 0.0), (dt.date(2025, 10, 3), 3.0, 2.0, 2.5, 1.0, 0.0)]
    forecast = spark.createDataFrame(rows, "Date date, " + ", ".join(f"{c} double" for c in WEATHER))
    out = forecast_at_horizon(features.horizon_expand(state), forecast)
    assert values(out, "Temp_Max", "horizon") == [1.0, 20.0, 3.0, 20.0, 20.0, 20.0, 20.0]
    assert values(out, "Temp_Min", "horizon")[:3] == [None, 5.0, 2.0]
    twice = forecast_at_horizon(features.horizon_expand(state), forecast.union(forecast))
    assert twice.count() == 7
