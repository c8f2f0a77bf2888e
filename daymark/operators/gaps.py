"""Calendar gaps in daily series: finding, profiling and filling them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.schema import DATE, TARGET, require_columns, series_window, whole


def calendar(df: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """Every day from the first to the last of each series."""
    spans = df.groupBy(*series_cols).agg(F.min(DATE).alias("_first"), F.max(DATE).alias("_last"))
    days = F.explode(F.sequence("_first", "_last", F.expr("interval 1 day"))).alias(DATE)
    return spans.where(F.col("_first").isNotNull()).select(*series_cols, days)


def calendar_except(df: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """Calendar minus the days that are present, as a set difference."""
    keys = [*series_cols, DATE]
    present = df.select(*keys)
    return calendar(df, series_cols).select(*keys).subtract(present)


def _next_day(series_cols: Sequence[str]) -> Column:
    return F.lead(DATE).over(series_window(series_cols))


def missing_dates(df: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """Absent days, read off the distance to the next present day (no join with a calendar)."""
    require_columns(df, [*series_cols, DATE], "daily series")
    following = df.select(*series_cols, DATE).withColumn("_next", _next_day(series_cols))
    holes = following.where(F.datediff("_next", DATE) > 1)
    days = F.sequence(F.date_add(DATE, 1), F.date_sub("_next", 1), F.expr("interval 1 day"))
    return holes.select(*series_cols, F.explode(days).alias(DATE))


def head_missing(df: DataFrame, series_cols: Sequence[str] = (), n: int = 5) -> DataFrame:
    """The first few absent days over all series (a report)."""
    return missing_dates(df, series_cols).orderBy(DATE, *series_cols).limit(n)


def gap_profile(df: DataFrame, series_cols: Sequence[str] = ()) -> DataFrame:
    """Calendar days, absent days and their share in percent."""
    spans = df.groupBy(*series_cols).agg(
        (F.datediff(F.max(DATE), F.min(DATE)) + 1).cast("bigint").alias("n_calendar_days"),
        F.count_distinct(DATE).alias("_present"),
    )
    absent = F.col("n_calendar_days") - F.col("_present")
    return spans.select(
        *series_cols,
        "n_calendar_days",
        absent.alias("n_missing"),
        (absent * 100.0 / F.col("n_calendar_days")).alias("missing_pct"),
    )


def weekday_median(
    df: DataFrame, series_cols: Sequence[str] = (), target_col: str = TARGET
) -> DataFrame:
    """Median count per weekday (0 = Monday) and over all days of the series."""
    values = df.select(*series_cols, F.weekday(DATE).alias("weekday"), F.col(target_col))
    both = values.groupingSets(
        [[*series_cols, "weekday"], [*series_cols]], *series_cols, "weekday"
    ).agg(F.median(target_col).alias("median_count"))
    return both


def gap_fill(
    df: DataFrame, series_cols: Sequence[str] = (), target_col: str = TARGET
) -> DataFrame:
    """Complete the calendar; an absent count becomes the median of its weekday.

    The weekday medians (or the overall median where that weekday never occurs) come from
    present days only and are cut to whole numbers. Columns other than the count are NULL on
    added days. One exchange by series, one window, one generator: no joins.
    """
    require_columns(df, [*series_cols, DATE, target_col], "daily series")
    w = series_window(series_cols)
    day, count = F.col(DATE), F.col(target_col)

    def median(value: Column) -> Column:
        # `percentile`, as `median` refuses a window that has an order.
        return F.percentile(value, F.lit(0.5)).over(whole(w))

    medians = [median(F.when(F.weekday(day) == i, count)) for i in range(7)]
    known = df.where(day.isNotNull()).withColumns(
        {
            "_next": F.lead(day).over(w),
            "_by_weekday": F.array(*medians),
            "_overall": median(count),
        }
    )
    last_absent = F.greatest(day, F.date_sub(F.coalesce("_next", day), 1))
    spread = known.withColumn("_day", F.explode(F.sequence(day, last_absent, F.expr("interval 1 day"))))
    present = F.col("_day") == day
    typical = F.coalesce(F.element_at("_by_weekday", F.weekday("_day") + 1), F.col("_overall"))
    filled = {
        DATE: F.col("_day"),
        target_col: F.coalesce(F.when(present, count), typical).cast("bigint"),
    }
    columns = []
    for c in df.columns:
        if c in series_cols:
            columns.append(F.col(c))
        elif c in filled:
            columns.append(filled[c].alias(c))
        else:
            columns.append(F.when(present, F.col(c)).alias(c))
    return spread.select(*columns)
