"""Queries for the model registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from daymark.operators import registry as reg
from daymark.suite import inputs as i
from daymark.suite.catalog import query, rounded, rounded_sql, with_ctes

BASE = with_ctes(i.REGISTRY)
ALL_NAMES = " UNION ALL ".join(f"SELECT 'daily_forecast_{n}' AS model_name" for n in i.MODEL_NAMES)
SLIM = ["model_name", "version", "stage"]


@query(
    "model_version_lookup",
    with_ctes(i.REGISTRY, i.CANDIDATES)
    + """ SELECT c.model_name, coalesce(CAST(live.version AS VARCHAR), 'unknown') AS model_version
        FROM (SELECT DISTINCT model_name FROM candidates) c LEFT JOIN live USING (model_name)""",
)
def model_version_lookup(spark, sf):
    return reg.model_version_lookup(i.candidates(spark, sf), i.registry(spark, sf))


@query(
    "model_paths",
    with_ctes(i.REGISTRY, i.CANDIDATES)
    + """ SELECT c.model_name, live.version, live.path
        FROM (SELECT DISTINCT model_name FROM candidates) c LEFT JOIN live USING (model_name)""",
)
def model_paths(spark, sf):
    return reg.model_paths(i.candidates(spark, sf), i.registry(spark, sf))


@query(
    "candidate_vs_baseline",
    with_ctes(i.REGISTRY, i.CANDIDATES)
    + """ SELECT c.*, CASE WHEN isnan(live.mae_tag) THEN NULL ELSE live.mae_tag END AS baseline_mae
        FROM candidates c LEFT JOIN live USING (model_name)""",
)
def candidate_vs_baseline(spark, sf):
    return reg.candidate_vs_baseline(i.candidates(spark, sf), i.registry(spark, sf))


@query(
    "promotion_decision",
    with_ctes(i.REGISTRY, i.CANDIDATES)
    + """, b AS (SELECT c.*, CASE WHEN isnan(live.mae_tag) THEN NULL ELSE live.mae_tag / 20000 END AS baseline_mae
              FROM candidates c LEFT JOIN live USING (model_name))
       SELECT *, coalesce(mae < baseline_mae, false) OR mae < 15 AS promoted FROM b""",
)
def promotion_decision(spark, sf):
    compared = reg.candidate_vs_baseline(i.candidates(spark, sf), i.registry(spark, sf))
    return reg.promotion_decision(compared.withColumn("baseline_mae", F.col("baseline_mae") / 20000))


@query(
    "register_version",
    with_ctes(i.REGISTRY, i.CANDIDATES)
    + """, best AS (SELECT model_name, min(mae) AS mae FROM candidates GROUP BY model_name),
       top AS (SELECT model_name, max(version) AS v FROM registry GROUP BY model_name)
       SELECT best.model_name, coalesce(top.v, 0) + 1 AS version, 'None' AS stage, CAST(best.mae AS DOUBLE) AS mae
       FROM best LEFT JOIN top USING (model_name)""",
)
def register_version(spark, sf):
    best = i.candidates(spark, sf).groupBy("model_name").agg(F.min("mae").alias("mae"))
    rows = best.select(
        "model_name",
        F.create_map(F.lit("mae"), F.col("mae").cast("string")).alias("tags"),
        F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("string").alias("path"),
        F.lit(0).alias("arrival"),
    )
    new = reg.register_version(i.registry(spark, sf), rows)
    return new.select("model_name", "version", "stage", reg.tag_value("tags", "mae").cast("double").alias("mae"))


@query(
    "promote",
    BASE
    + """, chosen AS (SELECT model_name, max(version) AS version FROM registry WHERE stage = 'None' GROUP BY model_name)
       SELECT r.model_name, r.version, CASE WHEN r.version = c.version THEN 'Production'
              WHEN r.stage = 'Production' AND c.version IS NOT NULL THEN 'Archived' ELSE r.stage END AS stage
       FROM registry r LEFT JOIN chosen c USING (model_name)""",
)
def promote(spark, sf):
    registry = i.registry(spark, sf)
    chosen = registry.where("stage = 'None'").groupBy("model_name").agg(F.max("version").alias("version"))
    return reg.promote(registry, chosen).select(*SLIM)


@query(
    "promote_any_picks",
    BASE
    + """, chosen AS (SELECT model_name, max(version) AS version FROM registry WHERE stage <> 'Staging' GROUP BY model_name)
       SELECT r.model_name, r.version, CASE WHEN r.version = c.version THEN 'Production'
              WHEN r.stage = 'Production' AND c.version IS NOT NULL THEN 'Archived' ELSE r.stage END AS stage
       FROM registry r LEFT JOIN chosen c USING (model_name)""",
)
def promote_any_picks(spark, sf):
    """Many picks of each model, each of them next to one of a version that does not exist."""
    registry = i.registry(spark, sf)
    picks = registry.where("stage <> 'Staging'").select("model_name", "version")
    absent = picks.select("model_name", (F.col("version") + F.lit(1 << 40)).alias("version"))
    return reg.promote(registry, picks.union(absent)).select(*SLIM)


@query(
    "keep_latest_versions",
    BASE
    + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY version DESC) AS rn FROM registry)
       SELECT model_name, version, CASE WHEN rn > 52 AND stage IN ('None', 'Staging') THEN 'Archived' ELSE stage END AS stage
       FROM ranked""",
)
def keep_latest_versions(spark, sf):
    return reg.keep_latest_versions(i.registry(spark, sf)).select(*SLIM)


@query(
    "registry_delete",
    BASE
    + """ SELECT model_name, version, stage FROM registry
        WHERE NOT (stage = 'Staging' AND version % 2 = 0)""",
)
def registry_delete(spark, sf):
    registry = i.registry(spark, sf)
    doomed = registry.where((F.col("stage") == "Staging") & (F.col("version") % 2 == 0))
    return reg.delete_versions(registry, doomed).select(*SLIM)


@query(
    "registry_describe",
    BASE
    + """ SELECT model_name, version, stage,
            CASE WHEN stage = 'Production' THEN 'live ' || CAST(version AS VARCHAR) END AS description FROM registry""",
)
def registry_describe(spark, sf):
    registry = i.registry(spark, sf)
    texts = registry.where("stage = 'Production'").select(
        "model_name", "version", F.concat(F.lit("live "), F.col("version").cast("string")).alias("description")
    )
    return reg.set_descriptions(registry, texts).select(*SLIM, "description")


@query(
    "candidate_summary",
    rounded_sql(
        with_ctes(i.REGISTRY, i.CANDIDATES)
        + """ SELECT model_name, CAST(count(*) AS BIGINT) AS n_candidates, min(mae) AS best_mae
            FROM candidates GROUP BY model_name""",
        ["best_mae"],
    ),
)
def candidate_summary(spark, sf):
    return rounded(
        i.candidates(spark, sf)
        .groupBy("model_name")
        .agg(F.count("*").alias("n_candidates"), F.min("mae").alias("best_mae"))
    )
