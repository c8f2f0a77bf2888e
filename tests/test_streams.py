import datetime as dt

import pytest

from daymark.operators.clean import daily_counts, dedup_visits
from daymark.plans.incremental import merge_visits, read_daily
from daymark.streaming.daily import streaming_daily_counts, write_closed_days

D = dt.datetime
KINDS = "series string, Surrogate_Key string, Contact_Start timestamp_ntz"


@pytest.fixture
def visits(spark):
    return lambda rows: spark.createDataFrame(rows, KINDS)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("series", "Date", "Patients_per_day").collect())


def test_stream_closes_days_and_survives_a_restart(spark, visits, tmp_path):
    source, path, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def deliver(*rows):
        visits(list(rows)).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(KINDS).parquet(source)
        write_closed_days(streaming_daily_counts(stream, ["series"]), path, state)
        return rows_of(spark.read.schema("series string, Date date, Patients_per_day bigint").parquet(path))

    first = ("a", "1", D(2024, 1, 1, 9))
    assert deliver(first, ("a", "2", D(2024, 1, 1, 23)), first, ("b", "1", D(2024, 1, 1, 9)), ("a", "x", None)) == []
    # The visit is repeated after a restart; the second of January begins.
    assert deliver(first, ("a", "3", D(2024, 1, 2, 1)), ("a", "4", D(2024, 1, 1, 22))) == []
    closed = [("a", dt.date(2024, 1, 1), 3), ("b", dt.date(2024, 1, 1), 1)]
    assert deliver(("a", "5", D(2024, 1, 3, 6))) == closed
    # Too late for a closed day, in time for an open one.
    late = deliver(("a", "6", D(2024, 1, 1, 10)), ("a", "7", D(2024, 1, 2, 10)), ("b", "9", D(2024, 1, 5)))
    assert late == [*closed[:1], ("a", dt.date(2024, 1, 2), 2), ("a", dt.date(2024, 1, 3), 1), *closed[1:]]


def test_stream_code_counts_a_batch_like_the_batch_code(visits):
    rows = [("a", str(k), D(2024, 1, 1) + dt.timedelta(hours=7 * (k % 50))) for k in range(120)] * 2
    batch = daily_counts(dedup_visits(visits(rows), series_cols=["series"]), ["series"])
    zone = visits(rows).sparkSession.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            visits(rows).sparkSession.conf.set("spark.sql.session.timeZone", name)
            assert rows_of(streaming_daily_counts(visits(rows), ["series"])) == rows_of(batch)
    finally:
        visits(rows).sparkSession.conf.set("spark.sql.session.timeZone", zone)


def test_merges_equal_the_full_run_and_touch_their_months_only(spark, visits, tmp_path):
    path = str(tmp_path / "state")
    rows = [("a" if k % 3 else "b", str(k % 40), D(2024, 1 + k % 5, 1 + k % 3, k % 24)) for k in range(300)]
    parts = [rows[:120], rows[100:200], rows[200:], [("a", "new", D(2024, 4, 4, 5)), ("a", "none", None)]]
    for part in parts[:3]:
        merge_visits(visits(part), path, ["series"])
    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "state").rglob("*.parquet")}
    before = files()
    assert merge_visits(visits(parts[3]), path, ["series"]) == ["2024-04"]
    after = files()
    assert all("2024-04" in str(f) for f in set(before.items()) ^ set(after.items()))
    every = [r for part in parts for r in part]
    full = daily_counts(dedup_visits(visits(every), series_cols=["series"]), ["series"])
    schema = visits(rows).select("series").schema
    assert rows_of(read_daily(spark, path, schema)) == rows_of(full)
    merge_visits(visits(every), path, ["series"])  # repeated deliveries change nothing
    assert rows_of(read_daily(spark, path, schema)) == rows_of(full)
    assert merge_visits(visits([]), path, ["series"]) == []


def test_earlier_months_are_not_read(spark, visits, tmp_path):
    path = str(tmp_path / "state")
    merge_visits(visits([("a", "1", D(2024, 1, 1)), ("a", "2", D(2024, 2, 2))]), path, ["series"])
    for f in (tmp_path / "state" / "visits" / "month=2024-01").glob("*.parquet"):
        f.write_bytes(b"not readable")
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    merge_visits(visits([("a", "3", D(2024, 2, 2))]), path, ["series"])
    counts = rows_of(read_daily(spark, path, visits([]).select("series").schema))
    assert counts == [("a", dt.date(2024, 1, 1), 1), ("a", dt.date(2024, 2, 2), 2)]
