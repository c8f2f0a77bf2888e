import datetime as dt

from daymark.operators import gaps, outliers
from tests.conftest import values

import pytest


def test_gap_fill_uses_the_overall_median_for_unseen_weekdays(daily):
    out = gaps.gap_fill(daily("2022-01-01", [10, None, 15, None, 20]))
    assert values(out, "Patients_per_day") == [10, 15, 15, 15, 20]


def test_gap_fill_uses_weekday_medians_cut_to_whole_numbers(daily):
    # Mondays 10 and 13: median 11.5 becomes 11.
    counts = [10, 1, 1, 1, 1, 1, 1, 13] + [1] * 6 + [None, 5]
    out = values(gaps.gap_fill(daily("2022-01-03", counts)), "Patients_per_day")
    assert out[14] == 11


def test_series_without_gaps_and_single_days_are_unchanged(daily):
    assert values(gaps.gap_fill(daily("2022-01-01", [1, 2, 3, 4, 5])), "Patients_per_day") == [1, 2, 3, 4, 5]
    assert values(gaps.gap_fill(daily("2022-01-01", [7])), "Patients_per_day") == [7]
    assert gaps.gap_fill(daily("2022-01-01", [7]).where("false")).count() == 0


def test_series_are_filled_on_their_own_calendars(daily):
    both = daily("2022-01-01", [10, None, 30], "a").union(daily("2022-03-01", [5, 5], "b"))
    out = gaps.gap_fill(both, ["series"])
    assert out.where("series = 'a'").count() == 3
    assert out.where("series = 'b'").count() == 2
    profile = {r.series: (r.n_calendar_days, r.n_missing) for r in gaps.gap_profile(both, ["series"]).collect()}
    assert profile == {"a": (3, 1), "b": (2, 0)}


def test_other_columns_are_null_on_added_days(daily):
    from pyspark.sql import functions as F

    out = gaps.gap_fill(daily("2022-01-01", [10, None, 30]).withColumn("note", F.lit("x")))
    assert values(out, "note") == ["x", None, "x"]


def test_missing_dates_and_calendar_agree(daily):
    df = daily("2022-01-01", [1, None, None, 4, None, 6])
    expected = [dt.date(2022, 1, 2), dt.date(2022, 1, 3), dt.date(2022, 1, 5)]
    assert values(gaps.missing_dates(df), "Date") == expected
    assert values(gaps.calendar_except(df), "Date") == expected
    assert [r.Date for r in gaps.head_missing(df, n=2).collect()] == expected[:2]


def test_gap_fill_plan_has_one_exchange_and_no_join(spark, daily):
    df = spark.createDataFrame(
        daily("2022-01-01", [1, None, 3], "a").collect(), "Date date, Patients_per_day bigint, series string"
    )
    plan = gaps.gap_fill(df, ["series"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_outliers(daily):
    counts = [50] * 10 + [52] * 10 + [54] * 10 + [200, 0]
    df = daily("2022-01-01", counts)
    bounds = outliers.outlier_bounds(df).first()
    assert (bounds.lower_bound, bounds.upper_bound) == (50 - 2 * 4, 54 + 2 * 4)
    flagged = outliers.handle_outliers(df, action="flag")
    assert [r.Patients_per_day for r in flagged.where("is_outlier").orderBy("Date").collect()] == [200, 0]
    assert values(outliers.handle_outliers(df), "Patients_per_day")[-2:] == [62, 42]
    assert outliers.handle_outliers(df, action="remove").count() == 30
    report = outliers.outlier_report(df).first()
    assert (report.n_below, report.n_above) == (1, 1)
    sides = {r.side: r.Patients_per_day for r in outliers.top_outliers(df).collect()}
    assert sides == {"high": 200, "low": 0}


def test_value_on_the_bound_is_no_outlier(daily):
    df = daily("2022-01-01", [50] * 10 + [52] * 10 + [54] * 10 + [62, 42])
    flagged = outliers.handle_outliers(df, action="flag")
    assert flagged.where("is_outlier").count() == 0
    assert "is_outlier" in flagged.columns


def test_lower_bound_is_never_negative_and_arguments_are_checked(daily):
    df = daily("2022-01-01", [1, 2, 50, 100])
    assert outliers.outlier_bounds(df).first().lower_bound == 0.0
    assert outliers.outlier_bounds(df, "percentile").first().lower_bound == pytest.approx(1.03)
    for wrong in ({"method": "zscore"}, {"action": "hide"}):
        with pytest.raises(ValueError):
            outliers.handle_outliers(df, **wrong)
