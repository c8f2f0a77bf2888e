import datetime as dt
import math
import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from daymark.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, shuffle_partitions=4, app="tests")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def daily(spark):
    """make(day, [counts], series=None): a daily series from consecutive counts; None leaves a gap."""

    def make(first, counts, series=None):
        first = dt.date.fromisoformat(first)
        rows = [
            (first + dt.timedelta(days=i), c) + ((series,) if series else ())
            for i, c in enumerate(counts)
            if c is not None
        ]
        kinds = "Date date, Patients_per_day bigint" + (", series string" if series else "")
        return spark.createDataFrame(rows, kinds)

    return make


@pytest.fixture(scope="session")
def year_of_counts():
    """A seeded series with a weekly and a yearly cycle."""

    def make(n, seed=42):
        rng = random.Random(seed)
        return [
            max(20, round(60 + 10 * math.sin(2 * math.pi * i / 7) + 15 * math.sin(2 * math.pi * i / 365) + rng.gauss(0, 5)))
            for i in range(n)
        ]

    return make


def values(df, column, order="Date"):
    return [r[column] for r in df.orderBy(order).collect()]
