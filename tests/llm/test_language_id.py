import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import SF

from daymark.llm.language_id import LetterModel, gram_codes, held_out, identify, learn


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abcß日", min_size=1, max_size=9), min_size=1, max_size=8))
def test_gram_codes(runs):
    codes, sizes = gram_codes(runs)
    expected = []
    for run in runs:
        marked = [0, 0, 0, *map(ord, run), 0]
        expected += [tuple(marked[i : i + 4]) for i in range(len(run) + 1)]
    assert [tuple(int(c) >> s & 0xFFFF for s in (48, 32, 16, 0)) for c in codes] == expected
    assert sizes.tolist() == [len(r) + 1 for r in runs]


def test_probabilities_sum_to_one():
    codes, _ = gram_codes(["abab", "abc", "bca", "aab"])
    grams, n = np.unique(codes, return_counts=True)
    model = LetterModel(grams, n, 4)
    letters = np.array([0, ord("a"), ord("b"), ord("c")], np.uint64)
    for context in [(0, 0, 0), (0, 0, ord("a")), (ord("a"), ord("b"), ord("a")), (9, 9, 9)]:
        prefix = sum(np.uint64(c) << np.uint64(s) for c, s in zip(context, (48, 32, 16), strict=True))
        assert np.exp(model.log_probabilities(prefix | letters)).sum() == pytest.approx(1)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    found = identify(docs.withColumn("held_out", held_out()), learn(docs)).toPandas()
    own = found[found.held_out]
    assert (own.lang == own.lang_pred).mean() > 0.97 and own.rejected.mean() < 0.03
    assert found.score.between(0, 1).all()


def test_held_out_texts_and_languages_are_not_seen(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    from pyspark.sql import functions as F

    changed = docs.withColumns({"text": F.when(held_out(), "changed").otherwise(F.col("text")), "lang": F.when(held_out(), "xx").otherwise(F.col("lang"))})
    one, two = learn(docs), learn(changed)
    assert one.langs == two.langs and (one.grams == two.grams).all() and (one.rows == two.rows).all()


def test_edges(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !?", "en"), (4, "the other", "en"), (4, "the other", "en"), (None, "le autre", None), (6, "zz " * 9000, "fr"), (8, "le autre", "fr"), (9, "x", None)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id bigint, text string, lang string, score double")
    found = identify(docs, learn(docs))
    assert found.count() == len(rows) and found.columns == ["doc_id", "text", "lang", "lang_pred", "score", "rejected"]
    by = {r.doc_id: r for r in found.collect()}
    assert [by[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and all(by[i].score == 0 and by[i].rejected for i in (1, 2, 3))
    assert by[None].lang_pred in ("en", "fr")
    none = identify(docs, learn(docs.limit(0)))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert identify(docs.limit(0), learn(docs)).count() == 0


def test_no_count_is_left_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").limit(300)
    more = docs.unionByName(spark.createDataFrame([(None, None, "en"), (900_001, "", "en"), (900_002, "日本語 の 文", "ja")], docs.schema))
    whole, small = learn(more), learn(more, 5000)
    assert len(whole.ranges) == 1 < len(small.ranges)
    one, two = (identify(more, m).toPandas().sort_values(["doc_id", "text"], ignore_index=True) for m in (whole, small))
    assert len(one) == len(two) == more.count()
    assert one["lang_pred"].equals(two["lang_pred"]) and one["rejected"].equals(two["rejected"])
    assert two["score"].to_numpy() == pytest.approx(one["score"].to_numpy(), abs=1e-5)
    assert len(small.grams) == len(whole.grams)
    assert np.sort(small.grams).tolist() == np.sort(whole.grams).tolist()
    order = np.argsort(small.grams)
    assert small.rows[order] == pytest.approx(whole.rows, abs=1e-6)


@pytest.mark.parametrize("block_grams", [2_000_000, 9_000])
def test_all_learning_texts_calibrate_the_rejection(spark, block_grams):
    """More texts than were once sampled; the errors' mean and spread are those of every learning text."""
    from pyspark.sql import functions as F

    text = F.translate(F.concat_ws(" ", F.col("id"), F.col("id") * 7919 % 100003), "0123456789", "abcdefghij")
    docs = spark.range(33_000).select(F.col("id").alias("doc_id"), text.alias("text"), F.when(F.col("id") % 2 == 0, "one").otherwise("two").alias("lang"))
    models = learn(docs, block_grams)
    assert (len(models.ranges) == 1) == (block_grams > 9_000)
    rows = docs.where(~held_out()).toPandas()
    assert len(rows) > 21_000
    blocks = [models.block(*bounds) for bounds in models.ranges]
    sums = sum(block.sums(list(rows["text"]))[0] for block in blocks)
    n = blocks[0].sums(list(rows["text"]))[1]
    for k, lang in enumerate(models.langs):
        own = (rows["lang"] == lang).to_numpy()
        cross = -sums[own, k] / n[own]
        mean = np.average(cross, weights=n[own])
        assert models.judge.mean[k] == pytest.approx(mean, rel=1e-9)
        assert models.judge.sd[k] == pytest.approx(np.sqrt(np.mean((cross - mean) ** 2 * n[own])) + 0.5, rel=1e-9)
