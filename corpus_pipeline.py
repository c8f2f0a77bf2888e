"""Documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm import decontaminate, language_id, ngram_join, packing, suffix_dedup
from daymark.llm.catalog import ship
from daymark.llm.shared import stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models don't reject. All documents with a language teach them; none is held out."""
    models = language_id.learn(docs, rows=F.lit(True))
    return language_id.identify(docs, models).where("NOT rejected").select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return ngram_join.keep_representatives(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings that occur elsewhere; n_chars follows. Letters that a cut broke go whole."""
    found = suffix_dedup.remove_repeats(docs)
    # Replacement letters of the text itself are set aside as a code point that stands for no letter.
    own, aside = "\ufffd", "\ufdd0"
    as_bytes = lambda letter: F.lit(letter.encode().decode("latin-1"))
    plain = F.replace(F.decode("kept", "ISO-8859-1"), as_bytes(own), as_bytes(aside))
    valid = F.make_valid_utf8(F.encode(plain, "ISO-8859-1").cast("string"))
    kept = F.replace(F.replace(valid, F.lit(own), F.lit("")), F.lit(aside), F.lit(own))
    text = F.when(F.size("runs") > 0, kept).otherwise(F.col("text"))
    changed = found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("bigint"))
    return changed.select(*docs.columns)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no run of words with an item of `benchmark`."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find_contamination(docs, benchmark).where("NOT contaminated").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", known_language),
    ("near-copies", one_of_near_copies),
    ("repeats", without_repeats),
    ("benchmarks", without_benchmarks),
    ("packing", packed),
]

#: The stages learn models and call tokenizers, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's rows written and read again as the next one's input."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
