"""Registration of the queries of this subpackage and of their SQL."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ROOT = Path(__file__).resolve().parents[2]


def ship(spark: SparkSession) -> None:
    """Send this subpackage to the Python workers, where their PYTHONPATH does not have it."""
    context = spark.sparkContext
    if str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "daymark_llm_sent", False):
        return
    path = Path(tempfile.mkdtemp()) / "daymark_llm.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in [ROOT / "daymark/__init__.py", *sorted((ROOT / "daymark/llm").glob("*.py"))]:
            out.write(file, file.relative_to(ROOT))
    context.addPyFile(str(path))
    context.daymark_llm_sent = True


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def sent(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = sent
        if sql is not None:
            ORACLES[name] = sql
        return sent

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
