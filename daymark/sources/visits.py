"""Visit records from delimited files, databases and printed tuples."""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.schema import KEY, TIME, VISITS

# Accepted form of a bracketed database object name.
BRACKETED_NAME = re.compile(r"(\[\w+\]\.)*\[\w+\]")
# Patterns of the printed-tuple format. A time has six or seven fields.
TUPLE_KEY = r"^\((\d+)"
TUPLE_TIME = r"datetime\.datetime\((\d{4}(?:,\s*\d{1,2}){5}(?:,\s*\d+)?)\)"


def scan_visits_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless `;` file: the first two fields are key and time, further fields are ignored.

    The permissive mode keeps rows with extra fields. A missing or empty input raises.
    """
    reader = spark.read.schema(VISITS).option("sep", ";").option("mode", "PERMISSIVE")
    try:
        visits = reader.csv(path)
    except AnalysisException as error:
        raise FileNotFoundError(path) from error
    if visits.isEmpty():
        raise ValueError(f"no visits in {path}")
    return visits


def is_bracketed_name(name: str) -> bool:
    return BRACKETED_NAME.fullmatch(name.replace(" ", "")) is not None


def scan_visits_db(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    num_partitions: int = 64,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Visits from a database table or view, read in parallel ranges of `partition_column`.

    The first two columns are taken as key and time whatever their names are. An empty table
    gives an empty result with the same schema.
    """
    if not url:
        raise ValueError("the connection URL must not be empty")
    if table.startswith("[") and not is_bracketed_name(table):
        raise ValueError(f"invalid table name {table!r}")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(num_partitions))
        )
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return first_two_columns(reader.load())


def first_two_columns(df: DataFrame) -> DataFrame:
    """Key as text and time as a local time stamp, from the first two columns of any table."""
    if len(df.columns) < 2:
        raise ValueError("visits need at least two columns")
    key, time = df.columns[:2]
    return df.select(
        F.col(f"`{key}`").cast("string").alias(KEY),
        F.col(f"`{time}`").cast("timestamp_ntz").alias(TIME),
    )


def db_or_file_fallback(
    spark: SparkSession, database: Mapping[str, Any] | None, csv_path: str
) -> DataFrame:
    """The database if configured and reachable, else the file.

    Spark reads lazily, so one row is fetched to find out whether the database answers.
    """
    if database:
        try:
            visits = scan_visits_db(spark, **database)
            visits.limit(1).collect()
            return visits
        except (PySparkException, ValueError, OSError):
            pass
        except Exception as error:  # errors of the database driver arrive as Java exceptions
            if "java" not in type(error).__module__ and "py4j" not in type(error).__module__:
                raise
    return scan_visits_csv(spark, csv_path)


def parse_tuple_dump(lines: DataFrame, column: str = "value") -> DataFrame:
    """Visits from printed tuples, one per line; lines without a key or a real time are skipped.

    Each line is matched once for its key and once for its time: the generator keeps the
    optimizer from repeating the matches in the filter below. The seventh field counts
    microseconds, so it is padded on the left.
    """
    text = F.trim(F.col(column))
    matched = F.struct(
        F.regexp_extract(text, TUPLE_KEY, 1).alias(KEY),
        F.split(F.regexp_extract(text, TUPLE_TIME, 1), r",\s*").alias("_t"),
    )
    found = lines.select(F.inline(F.array(matched)))

    def field(i: int, width: int) -> Column:
        return F.lpad(F.coalesce(F.get("_t", F.lit(i)), F.lit("0")), width, "0")

    iso = F.concat(
        F.concat_ws("-", field(0, 4), field(1, 2), field(2, 2)),
        F.lit(" "),
        F.concat_ws(":", field(3, 2), field(4, 2), field(5, 2)),
        F.lit("."),
        field(6, 6),
    )
    # Six zeros or more is no date, so lines without a time fall out with the invalid ones.
    visits = found.select(KEY, iso.try_cast("timestamp_ntz").alias(TIME))
    return visits.where((F.col(KEY) != "") & F.col(TIME).isNotNull())


def scan_tuple_dump(spark: SparkSession, path: str) -> DataFrame:
    """Visits from a file of printed tuples; no valid line is an error."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        raise FileNotFoundError(path) from error
    visits = parse_tuple_dump(lines)
    if visits.isEmpty():
        raise ValueError(f"no valid visit in {path}")
    return visits
