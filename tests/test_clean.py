import datetime as dt

import pytest

from daymark.operators import clean
from daymark.plans.preprocess import preprocess, preprocess_cached
from tests.conftest import values

D = dt.datetime
VISIT = "Surrogate_Key string, Contact_Start timestamp_ntz"


def visits(spark, rows, extra=""):
    return spark.createDataFrame(rows, VISIT + extra)


def test_dedup_keeps_one_per_visit(spark):
    days = [D(2022, 1, 1), D(2022, 1, 2), D(2022, 1, 2), D(2022, 1, 3)]
    out = clean.dedup_visits(visits(spark, list(zip(["1", "2", "2", "3"], days))))
    assert sorted(r.Surrogate_Key for r in out.collect()) == ["1", "2", "3"]


def test_dedup_other_columns_follow_the_first_row(spark):
    rows = [("1", D(2022, 1, 1), text) for text in ("first", "second", "third")]
    df = visits(spark, rows, ", Extra string").coalesce(1)
    assert [r.Extra for r in clean.dedup_visits(df).collect()] == ["first"]
    ordered = clean.dedup_visits(df, ingest_order=["Extra"])
    assert [r.Extra for r in ordered.collect()] == ["first"]


def test_same_key_at_another_time_is_another_visit(spark):
    out = clean.dedup_visits(visits(spark, [("1", D(2022, 1, 1, 8)), ("1", D(2022, 1, 1, 9))]))
    assert out.count() == 2


def test_dedup_collapses_a_hot_key_before_the_shuffle(spark):
    df = visits(spark, [("1", D(2022, 1, 1))]).crossJoin(spark.range(1000)).withColumnRenamed("id", "n")
    plan = clean.dedup_visits(df, ingest_order=["n"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
    assert clean.dedup_visits(df, ingest_order=["n"]).first().n == 0


def test_duplicate_profile(spark):
    rows = [("1", D(2022, 1, 1))] * 3 + [("2", D(2022, 1, 1))]
    row = clean.duplicate_profile(visits(spark, rows)).first()
    assert (row.n_rows, row.n_duplicates, row.duplicate_pct) == (4, 2, 50.0)
    empty = clean.duplicate_profile(visits(spark, [])).first()
    assert (empty.n_rows, empty.n_duplicates) == (0, 0)


def test_daily_counts(spark):
    rows = [("1", D(2022, 1, 1, 8)), ("2", D(2022, 1, 1, 23, 59)), ("3", D(2022, 1, 2)), ("4", None)]
    rows += [("5", D(2022, 1, 3)), ("6", D(2022, 1, 3))]
    out = clean.daily_counts(visits(spark, rows))
    assert out.columns == ["Date", "Patients_per_day"]
    assert values(out, "Patients_per_day") == [2, 1, 2]
    assert values(clean.daily_counts(visits(spark, rows), as_of=dt.date(2022, 1, 3)), "Patients_per_day") == [2, 1]


def test_incomplete_day(spark, daily):
    df = daily("2022-01-01", [5, 6, 7])
    assert values(clean.filter_incomplete_day(df, dt.date(2022, 1, 3)), "Patients_per_day") == [5, 6]
    assert clean.filter_incomplete_day(df).count() == 3
    assert clean.filter_incomplete_day(df.where("false")).count() == 0


def test_drop_null_rows(spark):
    df = spark.createDataFrame([(1.0, 10), (2.0, 20), (None, 30), (4.0, None), (float("nan"), 50)], "A double, B int")
    assert clean.drop_null_rows(df).count() == 2
    profile = {r.column_name: r.n_missing for r in clean.null_profile(df).collect()}
    assert profile == {"A": 2, "B": 1}
    assert clean.null_profile(df).first().rows_affected == 3


def test_preprocess_end_to_end(spark):
    rows = []
    for day in range(60):
        if day == 30:
            continue
        n = 500 if day == 40 else 10 + day % 7
        rows += [(f"{day}-{k}", D(2022, 1, 3) + dt.timedelta(days=day, hours=8)) for k in range(n)] * 2
    last = dt.date(2022, 1, 3) + dt.timedelta(days=59)
    out = preprocess(visits(spark, rows), as_of=last)
    counts = values(out, "Patients_per_day")
    assert len(counts) == 59
    assert counts[30] == 10 + 30 % 7  # weekday median of the hole
    assert counts[40] < 500  # capped
    uncapped = values(preprocess_cached(visits(spark, rows), as_of=last), "Patients_per_day")
    assert uncapped[40] == 500


def test_missing_column_is_an_error(spark, daily):
    with pytest.raises(KeyError):
        clean.daily_counts(daily("2022-01-01", [1]))
