"""Daily counts kept as a state that new visits merge into.

The state holds the distinct visits and the counts of each day, both partitioned by month. A merge reads
and rewrites the months of the new visits only. Each rewrite replaces whole months, so a merge that failed
or is repeated leaves the same state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.schema import DATE, KEY, TARGET, TIME, require_columns
from daymark.session import cut_lineage


#: Partition of the state: year and month of the day.
MONTH = "month"


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return spark.createDataFrame([], schema)


def _replace_months(df: DataFrame, path: str) -> None:
    spread = df.hint("rebalance", MONTH)  # few files for a month, one with very many rows in several
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def merge_visits(visits: DataFrame, path: str, series_cols: Sequence[str] = ()) -> list[str]:
    """Merge visits into the state at `path`; returns the months that were rewritten.

    Visits that the state holds already, or that are repeated, change nothing. Visits without a time are left out.
    """
    columns = [*series_cols, KEY, TIME]
    require_columns(visits, columns, "visits")
    month = F.date_format(TIME, "yyyy-MM").alias(MONTH)
    fresh = cut_lineage(visits.select(*columns, month).where(F.col(TIME).isNotNull()).distinct())
    months = sorted(r[MONTH] for r in fresh.select(MONTH).distinct().collect())  # bounded by the calendar
    if not months:
        return []
    known = _stored(visits.sparkSession, f"{path}/visits", fresh.schema).where(F.col(MONTH).isin(months))
    # The merged months replace what they are read from.
    merged = cut_lineage(known.unionByName(fresh).distinct())
    _replace_months(merged, f"{path}/visits")
    counts = merged.groupBy(*series_cols, F.to_date(TIME).alias(DATE), MONTH).agg(F.count("*").alias(TARGET))
    _replace_months(counts, f"{path}/counts")
    return months


def read_daily(spark: SparkSession, path: str, series: T.StructType | None = None) -> DataFrame:
    """The daily counts of the state: series columns (of these types), Date, count."""
    fields = [*(series or T.StructType()), T.StructField(DATE, T.DateType()), T.StructField(TARGET, T.LongType()), T.StructField(MONTH, T.StringType())]
    return _stored(spark, f"{path}/counts", T.StructType(fields)).drop(MONTH)
