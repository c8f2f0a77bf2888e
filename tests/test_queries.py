"""Every query with SQL gives the rows, names and types of that SQL; the others give rows."""

import pytest

import __spark_entry__ as entry_points
from tests.compare import connect, duck_rows, kinds_duck, kinds_spark, spark_rows
from tests.conftest import SF

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    names, rows = spark_rows(df)
    expected_names, expected = duck_rows(duck, ORACLES[name])
    assert names == expected_names
    assert {k: TYPES.get(v, v) for k, v in kinds_spark(df).items()} == kinds_duck(duck, ORACLES[name])
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert rows
    for row in rows:
        point = row.asDict()
        if "lower_bound" in point:
            assert point["lower_bound"] <= point["point_prediction"] <= point["upper_bound"]


def test_entry(spark):
    df = entry_points.entry(spark)
    assert {"series", "Date", "Patients_per_day", "patients_lag_28", "patients_30d_std"} <= set(df.columns)
    assert df.count() > 1000
