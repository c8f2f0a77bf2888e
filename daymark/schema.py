"""Column names, table schemas and small schema checks shared by all operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the data model.
KEY = "Surrogate_Key"
TIME = "Contact_Start"
DATE = "Date"
TARGET = "Patients_per_day"
WEATHER = ["Temp_Max", "Temp_Min", "Temp_Mean", "Precipitation", "Snowfall"]
LABEL = "target"
HORIZON = "horizon"
SPLIT = "split"
HORIZONS = tuple(range(1, 8))

VISITS = T.StructType(
    [T.StructField(KEY, T.StringType()), T.StructField(TIME, T.TimestampNTZType())]
)
DAILY = T.StructType(
    [T.StructField(DATE, T.DateType()), T.StructField(TARGET, T.LongType())]
)
WEATHER_TABLE = T.StructType(
    [T.StructField(DATE, T.DateType())] + [T.StructField(c, T.DoubleType()) for c in WEATHER]
)
PREDICTION = T.StructType(
    [
        T.StructField("prediction_timestamp", T.TimestampNTZType(), False),
        T.StructField("prediction_date", T.DateType(), False),
        T.StructField(HORIZON, T.IntegerType(), False),
        T.StructField("model_version", T.StringType(), False),
        T.StructField("point_prediction", T.DoubleType(), False),
        T.StructField("lower_bound", T.DoubleType(), False),
        T.StructField("upper_bound", T.DoubleType(), False),
    ]
)
ACTUALS = T.StructType(
    [T.StructField("date", T.DateType()), T.StructField("patient_count", T.LongType())]
)
MODEL_PERFORMANCE = T.StructType(
    [
        T.StructField("evaluation_date", T.DateType(), False),
        T.StructField("model_version", T.StringType(), False),
        T.StructField(HORIZON, T.IntegerType(), False),
        T.StructField("mae", T.DoubleType(), False),
        T.StructField("rmse", T.DoubleType(), False),
        T.StructField("coverage", T.DoubleType()),
        T.StructField("interval_width", T.DoubleType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)
TRACKING_LOG = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField(HORIZON, T.IntegerType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("rolling_mae", T.DoubleType()),
        T.StructField("n_predictions", T.LongType()),
    ]
)
REGISTRY = T.StructType(
    [
        T.StructField("model_name", T.StringType(), False),
        T.StructField("version", T.LongType(), False),
        T.StructField("stage", T.StringType(), False),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("description", T.StringType()),
        T.StructField("path", T.StringType()),
    ]
)
RUN_METRICS = T.StructType(
    [
        T.StructField("ts", T.TimestampNTZType(), False),
        T.StructField("metric", T.StringType(), False),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("value", T.DoubleType()),
    ]
)


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "table") -> DataFrame:
    """Raise KeyError when a needed column is absent; otherwise return the table."""
    missing = missing_names(columns, df.columns)
    if missing:
        raise KeyError(f"{what} lacks columns {missing}")
    return df


def missing_names(required: Iterable[str], present: Iterable[str]) -> list[str]:
    """Names that are required but not present, sorted."""
    return sorted(set(required) - set(present))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column, so only one kind of missing is left."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating})


def series_window(
    series_cols: Sequence[str] = (), order: Sequence[str | Column] | str = DATE
) -> WindowSpec:
    """Window over one series in date order.

    Used on daily tables only: a series has at most one row per calendar day, so
    a window partition is bounded by the calendar however many raw rows there were.
    """
    order = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*series_cols).orderBy(*order)


def whole(window: WindowSpec) -> WindowSpec:
    """The same partition and order with an unbounded frame: shares one sort with it."""
    return window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def in_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast and order columns as a table schema asks; other columns are left out."""
    require_columns(df, schema.fieldNames())
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def join_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on null-safe equality of the keys and keep the left key columns.

    Grouping treats NULL keys as equal, so joining an aggregate back has to as well.
    """
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_right_{key}"))
    return left.join(renamed, condition, how).drop(*[f"_right_{key}" for key in keys])
