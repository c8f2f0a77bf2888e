import collections
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import EDGES

from daymark.llm.quality_rules import COUNTS, Rule, judge_quality, learn, text_counts


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, repeated = collections.Counter(grams), set()
    for i, gram in enumerate(grams):
        if times[gram] > 1:
            repeated |= set(range(i, i + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab# \n\x0b\x85\xa0é|", max_size=80))
def test_counts(text):
    assert text_counts(text)[: len(COUNTS)] == brute(text)


def test_learned_rules_are_ordered_and_precise():
    rng = np.random.default_rng(0)
    rows = {"a": rng.random(3000), "b": rng.random(3000), "c": rng.random(3000)}
    bad = (rows["a"] > 0.8) | ((rows["b"] < 0.2) & (rows["c"] > 0.5))
    rules = learn(rows, bad)
    covered = np.zeros(3000, bool)
    for rule in rules:
        covered |= rule.covers(rows)
    assert 2 <= len(rules) <= 6 and (covered == bad).mean() > 0.98
    assert learn(rows, np.zeros(3000, bool)) == []
    assert learn({"a": rng.random(900)}, rng.random(900) < 0.3) == []  # nothing to learn from noise


def test_rule_as_expression(spark):
    rule = Rule((("words", True, 3.0), ("symbols", False, 0.5)))
    rows = spark.createDataFrame([(5, 1, 0, 0, 0), (5, 9, 9, 0, 0), (2, 0, 0, 0, 0)], "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint")
    more = rows.selectExpr("*", "1L n_lines", "0L n_upper", "0L n_digits", "0L n_marks", "1L n_distinct")
    assert [r[0] for r in more.select(rule.condition()).collect()] == [True, False, False]


def test_edges_and_learning(spark, docs):
    good = [(100 + i, f"a plain text number {i} with more than ten words that differ from each other in every line") for i in range(60)]
    bad = [(200 + i, f"## $$ text %% number && {i} with ** more than ten words that || differ from << each other") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 0, 0), (100, None, 0), (100, 1, 1)], "doc_id bigint, quality int, toxic int")
    found = {r.doc_id: r for r in judge_quality(docs(EDGES + good + bad), labels).collect()}
    assert all(found[i].kept for i, _ in good) and not any(found[i].kept or found[i].base_failed for i, _ in bad)
    assert found[1].n_words == 0 and found[1].base_failed and found[None].base_failed
    assert judge_quality(docs(EDGES).limit(0), labels).count() == 0
    assert judge_quality(docs(good), labels.limit(0)).where("kept").count() == 60
