"""Visits to a clean daily series."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from daymark.operators.clean import daily_counts, dedup_visits, filter_incomplete_day, filter_zero_days
from daymark.operators.gaps import gap_fill
from daymark.operators.outliers import handle_outliers
from daymark.schema import KEY, TIME


def _finished_days(
    visits: DataFrame, series_cols: Sequence[str], as_of: dt.date | Column | None
) -> DataFrame:
    # Only the columns that count are carried into the shuffle that removes duplicates.
    slim = visits.select(*series_cols, KEY, TIME)
    if as_of is not None:
        return daily_counts(dedup_visits(slim, series_cols=series_cols), series_cols, as_of)
    return filter_incomplete_day(daily_counts(dedup_visits(slim, series_cols=series_cols), series_cols))


def preprocess(
    visits: DataFrame, series_cols: Sequence[str] = (), as_of: dt.date | Column | None = None
) -> DataFrame:
    """Duplicates out, count days, drop the unfinished day, fill gaps, cap outliers."""
    daily = gap_fill(_finished_days(visits, series_cols, as_of), series_cols)
    return handle_outliers(daily, action="cap", series_cols=series_cols)


def preprocess_cached(
    visits: DataFrame, series_cols: Sequence[str] = (), as_of: dt.date | Column | None = None
) -> DataFrame:
    """The variant without the outlier step that drops days with no visits instead."""
    return filter_zero_days(gap_fill(_finished_days(visits, series_cols, as_of), series_cols))
