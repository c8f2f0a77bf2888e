import corpus_pipeline
import duckdb
import pytest
from tests.conftest import SF

from daymark.llm import shared


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    before, seen = docs, set()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        from daymark.llm.shared import stored

        after = stored(after, "test")
        ids, old = {r.doc_id for r in after.select("doc_id").collect()}, {r.doc_id for r in before.select("doc_id").collect()}
        assert ids <= old and len(ids) > 0.5 * len(old)
        seen.add(len(ids))
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert {r.doc_id for r in last.select("doc_id").distinct().collect()} == ids
    copies = duckdb.sql(f"SELECT min(doc_id) FROM '{SF}/documents.parquet' GROUP BY text HAVING count(*) > 1").fetchall()
    kept_twice = duckdb.sql(f"SELECT doc_id FROM '{SF}/documents.parquet' QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1").fetchall()
    assert copies and not ids & {r[0] for r in kept_twice}


def test_edges(spark):
    rows = [(1, None, None, None, None), (1, "", "en", "s", 0), (None, "one more text", None, "s", 3), (3, "the word and the text", "en", "s", 3), (3, "the word and the text", "en", "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, table, SF).columns == docs.columns
            stage(spark, table, SF).collect()


def test_all_documents_teach_the_languages(spark):
    """A language of documents that op8 would hold out, or without an id, is known to the pipeline."""
    from pyspark.sql import functions as F

    from daymark.llm.language_id import held_out

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = lambda first: F.translate(F.concat_ws(" ", F.col("id"), F.col("id") * 7919 % 100003), "0123456789", first)
    row = lambda lang, first: [text(first).alias("text"), F.lit(lang).alias("lang"), F.lit("s").alias("source"), F.lit(9).cast("bigint").alias("n_chars")]
    some = spark.range(10_000_000, 10_000_600)
    held = some.select(F.col("id").alias("doc_id"), *row("ja", "あいうえおかきくけこ")).where(held_out())
    nameless = some.select(F.lit(None).cast("bigint").alias("doc_id"), *row("ru", "абвгдежзик"))
    kept = corpus_pipeline.known_language(spark, docs.unionByName(held).unionByName(nameless), SF)
    found = {r.lang: r["count"] for r in kept.groupBy("lang").count().collect()}
    assert found["ja"] == held.count() > 100 and found["ru"] == 600


@pytest.mark.parametrize("stage", [corpus_pipeline.known_language, corpus_pipeline.one_of_near_copies])
def test_texts_go_to_python_in_batches_of_bounded_bytes(spark, stage):
    """However many rows Spark would send, a worker holds a few MB of texts. A size that the session names stays."""
    setting, size = "spark.sql.execution.arrow.maxBytesPerBatch", 100_000
    docs = spark.range(100).selectExpr("id AS doc_id", f"repeat(concat(id, ' word '), {size} div 7) AS text", "'en' AS lang", "'s' AS source", "1L AS n_chars").coalesce(1)
    bytes_of = lambda frames: (frame[["n"]].assign(n=frame["text"].str.len().sum())[:1] for frame in frames)
    sent = lambda: [r.n for r in docs.selectExpr("text", "1L AS n").mapInPandas(bytes_of, "n bigint").collect()]
    before = spark.conf.get(setting, None)
    try:
        spark.conf.unset(setting)
        assert max(sent()) == sum(sent()) > 50 * size
        assert stage(spark, docs, SF).count() == 100
        assert max(sent()) <= shared.BATCH_BYTES + size and sum(sent()) > 50 * size
        spark.conf.set(setting, "1m")
        stage(spark, docs.limit(2), SF)
        assert spark.conf.get(setting) == "1m"
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
