"""Session settings and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "daymark") -> SparkSession:
    """Single-machine session for tests and benches. A cluster brings its own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the session names.

    Only where neither the session nor the context names one (tests on one machine) is a
    temporary folder used.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="daymark-checkpoint-"))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """A folder every executor sees: the checkpoint folder the session names, else (tests) a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return str(named) if named else tempfile.mkdtemp(prefix="daymark-shared-")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, where their PYTHONPATH does not have it."""
    context, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "daymark_sent", False):
        return
    path = Path(tempfile.mkdtemp()) / "daymark_package.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted((root / "daymark").rglob("*.py")):
            out.write(file, file.relative_to(root))
    context.addPyFile(str(path))
    context.daymark_sent = True
