"""Quality rules: learned decision lists over statistics of texts.

One pass writes the statistics of every document. A bounded sample of labelled documents trains a
list of rules by sequential covering: a rule is grown by adding the threshold test that gains most
(FOIL's gain) on two thirds of the sample, pruned on the last third, and the documents that it
covers are taken out before the next rule is grown. The list becomes one ordered chain of Spark's
conditional expressions, which judges all documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.shared import appended, rolled, stored

WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Separators of words: those of the contract, one byte each.
_SPACES = " \t\n\x0b\x0c\r"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MORE = ["n_lines", "n_upper", "n_digits", "n_marks", "n_distinct"]
#: Labelled documents that train the list: those with the smallest hashes of their ids.
SAMPLE_ROWS = 20_000


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 5-word window found twice or more in the text."""
    if len(words) <= WINDOW:
        return 0
    grams = rolled(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64), WINDOW)
    order = np.argsort(grams)
    ranked = grams[order]
    equal = ranked[1:] == ranked[:-1]
    if not equal.any():
        return 0
    twice = np.zeros(len(grams), bool)
    twice[order[1:][equal]] = twice[order[:-1][equal]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    edges[starts] += 1
    edges[starts + WINDOW] -= 1
    return int((np.cumsum(edges) > 0).sum())


def text_counts(text: str) -> tuple[int, ...]:
    """COUNTS and further counts of a whole text."""
    words = text.encode("utf-8", "replace").split()
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
        sum(map(str.isupper, text.split())),
        sum(map(text.count, "0123456789")),
        sum(map(text.count, "!?;:")),
        len(set(words)),
    )


def document_counts(docs: DataFrame) -> DataFrame:
    """docs with the counts of its column text; a null text has none of anything."""
    count = lambda texts: list(zip(*map(text_counts, texts), strict=True))
    return appended(docs, ["text"], count, ", ".join(f"{c} bigint" for c in COUNTS + _MORE))


def features() -> dict[str, Column]:
    """Ratios that rules test, by name; of texts without words all are 0."""
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / words,
        "dup_lines": F.col("n_dup_lines") / lines,
        "repeats": F.col("n_repeat_words") / words,
        "upper": F.col("n_upper") / words,
        "digits": F.col("n_digits") / words,
        "marks": F.col("n_marks") / words,
        "line_words": F.col("n_words") / lines,
        "distinct": F.col("n_distinct") / words,
    }


@dataclass(frozen=True)
class Rule:
    """Tests (feature, above, threshold) that all have to hold."""

    tests: tuple[tuple[str, bool, float], ...]

    def covers(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        held = np.ones(len(next(iter(rows.values()))), bool)
        for name, above, threshold in self.tests:
            held &= rows[name] > threshold if above else rows[name] <= threshold
        return held

    def condition(self) -> Column:
        found = features()
        held = F.lit(True)
        for name, above, threshold in self.tests:
            held = held & (found[name] > threshold if above else found[name] <= threshold)
        return held

    def __str__(self) -> str:
        return " and ".join(f"{name} {'>' if above else '<='} {threshold:.6g}" for name, above, threshold in self.tests)


def _grow(rows: dict[str, np.ndarray], bad: np.ndarray, most_tests: int) -> Rule:
    tests: list[tuple[str, bool, float]] = []
    inside = np.ones(len(bad), bool)
    while len(tests) < most_tests and bad[inside].sum() < inside.sum():
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        before = math.log2(p0 / (p0 + n0))
        best = (1e-9, None)
        for name, column in rows.items():
            x, y = column[inside], bad[inside]
            order = np.argsort(x, kind="stable")
            x, y = x[order], y[order]
            cuts = np.flatnonzero(x[1:] > x[:-1])
            p = np.cumsum(y)[cuts]
            total = cuts + 1
            for above in (False, True):
                pos, size = (p0 - p, len(x) - total) if above else (p, total)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pos > 0, pos * (np.log2(pos / size) - before), 0.0)
                if len(gain) and gain.max() > best[0]:
                    i = int(gain.argmax())
                    best = (float(gain[i]), (name, above, float((x[cuts[i]] + x[cuts[i] + 1]) / 2)))
        if best[1] is None:
            break
        tests.append(best[1])
        inside = Rule(tuple(tests)).covers(rows)
    return Rule(tuple(tests))


def _worth(rule: Rule, rows: dict[str, np.ndarray], bad: np.ndarray) -> float:
    held = rule.covers(rows)
    p, n = bad[held].sum(), (~bad[held]).sum()
    return (p - n) / (p + n) if p + n else -1.0


def learn(rows: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.9, most_rules: int = 20, most_tests: int = 5) -> list[Rule]:
    """Rules for bad rows, in order. A rule is kept while at least `precision` of what it covers,
    in the pruning part and in all, is bad; none are learned from one kind of rows only."""
    part = np.arange(len(bad)) % 3 == 2
    left, found = np.ones(len(bad), bool), []
    cut = lambda mask: ({k: v[mask] for k, v in rows.items()}, bad[mask])
    while len(found) < most_rules and bad[left & ~part].any():
        rule = _grow(*cut(left & ~part), most_tests)
        held_out, all_left = cut(left & part), cut(left)
        while len(rule.tests) > 1 and _worth(shorter := Rule(rule.tests[:-1]), *held_out) >= _worth(rule, *held_out):
            rule = shorter
        least = 2 * precision - 1
        if not rule.tests or _worth(rule, *held_out) < least or _worth(rule, *all_left) < least:
            break
        found.append(rule)
        left &= ~rule.covers(rows)
    return found


def fit(counts: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn from at most `sample_rows` labelled documents (doc_id, quality 0 or 1).

    Rows without a label or an id are left out; a document labelled both ways counts as bad.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    wanted = known.select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    one = counts.join(wanted, "doc_id").dropDuplicates(["doc_id"])
    sample = one.select("doc_id", (F.col("quality") == 0).alias("bad"), *(c.alias(n) for n, c in features().items())).toPandas()
    sample = sample.sort_values("doc_id", key=lambda ids: pd.util.hash_array(ids.to_numpy(np.int64)))
    bad = sample.pop("bad").to_numpy(bool)
    return learn({c: sample[c].to_numpy(float) for c in features()}, bad)


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1; 0 if none does."""
    chain = None
    for number, rule in enumerate(rules, 1):
        chain = F.when(rule.condition(), number) if chain is None else chain.when(rule.condition(), number)
    return F.lit(0) if chain is None else chain.otherwise(0)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rule).

    One row for each row of docs (doc_id, text); other columns are ignored, whatever their names.
    A null or empty text has no words and fails. `rule` is the number of the learned rule that
    rejects the document, 0 if none does. Without labels no rule is learned. No documents give no rows.
    """
    counts = stored(document_counts(docs.select(F.col("doc_id").cast("bigint"), "text")).drop("text"), "quality-counts")
    rules = fit(counts, labels, sample_rows)
    judged = counts.withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return judged.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")
