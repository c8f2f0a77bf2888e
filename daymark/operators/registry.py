"""Model registry as a table: one row per (model_name, version) with stage and tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRODUCTION, ARCHIVED, STAGING, NO_STAGE = "Production", "Archived", "Staging", "None"
# Promotion threshold and registry retention.
MAE_THRESHOLD = 15.0
KEEP_VERSIONS = 52


def production_versions(registry: DataFrame) -> DataFrame:
    """Newest production row of each model."""
    rest = [c for c in registry.columns if c != "model_name"]
    live = registry.where(F.col("stage") == PRODUCTION)
    newest = live.groupBy("model_name").agg(F.max_by(F.struct(*rest), "version").alias("_row"))
    return newest.select("model_name", *[F.col(f"_row.{c}").alias(c) for c in rest])


def model_version_lookup(names: DataFrame, registry: DataFrame) -> DataFrame:
    """Production version of each asked model as text, `unknown` where there is none."""
    live = production_versions(registry).select("model_name", "version")
    version = F.coalesce(F.col("version").cast("string"), F.lit("unknown"))
    return names.select("model_name").distinct().join(live, "model_name", "left").select(
        "model_name", version.alias("model_version")
    )


def register_version(registry: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows to append: versions count on from the highest of each model.

    `candidates` has model_name, tags, description, path and an `arrival` column that orders
    several candidates of one model.
    """
    highest = registry.groupBy("model_name").agg(F.max("version").alias("_max"))
    place = F.row_number().over(Window.partitionBy("model_name").orderBy("arrival"))
    return (
        candidates.withColumn("_place", place)
        .join(highest, "model_name", "left")
        .select(
            "model_name",
            (F.coalesce("_max", F.lit(0)) + F.col("_place")).cast("bigint").alias("version"),
            F.lit(NO_STAGE).alias("stage"),
            "tags",
            "description",
            "path",
        )
    )


def tag_value(tags: str, name: str) -> Column:
    """A tag, with an empty text counted as absent."""
    return F.nullif(F.try_element_at(F.col(tags), F.lit(name)), F.lit(""))


def candidate_vs_baseline(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """Add `baseline_mae`: the error tag of the production version, NULL if there is none."""
    tagged = F.coalesce(tag_value("tags", "mae"), tag_value("tags", "test_mae"))
    baseline = production_versions(registry).select(
        "model_name", tagged.try_cast("double").alias("baseline_mae")
    )
    return candidates.join(baseline, "model_name", "left")


def promotion_decision(
    df: DataFrame, threshold: float = MAE_THRESHOLD, require_both: bool = False
) -> DataFrame:
    """Add `promoted`: better than the baseline or below the threshold (or both, if asked)."""
    better = F.coalesce(F.col("mae") < F.col("baseline_mae"), F.lit(False))
    good = F.col("mae") < F.lit(float(threshold))
    return df.withColumn("promoted", (better & good) if require_both else (better | good))


def promote(registry: DataFrame, chosen: DataFrame, archive_existing: bool = True) -> DataFrame:
    """Registry with the chosen (model_name, version) in production.

    Earlier production versions of those models are archived unless asked otherwise. Picks of
    versions that do not exist are left out; of several picks of one model the highest version counts.
    """
    keys = ["model_name", "version"]
    present = chosen.select(*keys).join(registry.select(*keys), keys, "left_semi")
    picks = present.groupBy("model_name").agg(F.max("version").alias("_chosen"))
    joined = registry.join(picks, "model_name", "left")
    stage = F.when(F.col("version") == F.col("_chosen"), PRODUCTION)
    if archive_existing:
        stage = stage.when((F.col("stage") == PRODUCTION) & F.col("_chosen").isNotNull(), ARCHIVED)
    return joined.withColumn("stage", stage.otherwise(F.col("stage"))).select(*registry.columns)


def _oldest_kept(registry: DataFrame, keep_n: int) -> DataFrame:
    # The rank filter is planned as a group limit: each task keeps only its own newest
    # `keep_n` rows per model before the shuffle, so a model with very many versions is cheap.
    newest_first = Window.partitionBy("model_name").orderBy(F.col("version").desc())
    kept = (
        registry.select("model_name", "version")
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= keep_n)
    )
    return kept.groupBy("model_name").agg(
        F.min("version").alias("_oldest"), F.count("*").alias("_kept")
    )


def keep_latest_versions(
    registry: DataFrame,
    keep_n: int = KEEP_VERSIONS,
    stages: Sequence[str] = (NO_STAGE, STAGING),
) -> DataFrame:
    """Registry with versions beyond the newest `keep_n` archived, if in one of `stages`.

    The rank counts versions of all stages.
    """
    limits = _oldest_kept(registry, keep_n)
    joined = registry.join(limits, "model_name", "left")
    old = F.col("_oldest").isNull() | (F.col("version") < F.col("_oldest"))
    stage = F.when(old & F.col("stage").isin(*stages), ARCHIVED).otherwise(F.col("stage"))
    return joined.withColumn("stage", stage).select(*registry.columns)


def newly_archived(
    registry: DataFrame, keep_n: int = KEEP_VERSIONS, stages: Sequence[str] = (NO_STAGE, STAGING)
) -> DataFrame:
    """Versions that `keep_latest_versions` archives."""
    kept = keep_latest_versions(registry, keep_n, stages)
    before = registry.select("model_name", "version", F.col("stage").alias("_before"))
    changed = kept.join(before, ["model_name", "version"]).where(F.col("stage") != F.col("_before"))
    return changed.select(*registry.columns)


def delete_versions(registry: DataFrame, doomed: DataFrame) -> DataFrame:
    keys = ["model_name", "version"]
    return registry.join(doomed.select(*keys), keys, "left_anti")


def set_descriptions(registry: DataFrame, texts: DataFrame) -> DataFrame:
    """Replace the description where `texts` (model_name, version, description) has one."""
    keys = ["model_name", "version"]
    new = texts.select(*keys, F.col("description").alias("_new"))
    joined = registry.join(new, keys, "left")
    text = F.coalesce("_new", "description")
    return joined.withColumn("description", text).select(*registry.columns)


def model_paths(names: DataFrame, registry: DataFrame, version: int | None = None) -> DataFrame:
    """Storage path per model: the production version, or one given version."""
    rows = production_versions(registry) if version is None else registry.where(F.col("version") == version)
    asked = names.select("model_name").distinct()
    return asked.join(rows, "model_name", "left").select("model_name", "version", "path")
