"""Language ID: interpolated Kneser-Ney models of letters, one for each language.

Texts are lower-cased and cut into runs of letters; each run is read with a mark on both ends.
Spark counts the letter 4-grams of all learning texts by language, and from them those of the lower orders, whose
counts are those of distinct left neighbours, and the discounts. No count is left out. An order's discounted counts
are interpolated with the order below.

Scoring reads the counts in blocks of a bounded size: ranges of a gram's third and second letter. A block holds
all counts that the probabilities of its grams take, seen or not, since a gram's contexts share these letters. It
is a sorted array of 4-grams with a row of log probabilities, and sorted arrays for the orders below. One block
scores the texts in one pass; several score them one after another, and a text's sums are added up. A text's
language is the one with the lowest cross-entropy per letter. A text is rejected if that is above what all of the
language's learning texts show, for its length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, reduce
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.shared import appended, bounded_batches, chunks, stored, tasks

ORDER = 4
_LETTERS = re.compile(r"[^\W\d_]+")
#: Counts (language, 4-gram) of a block. More make more blocks.
BLOCK_GRAMS = 2_000_000
#: Rejection: cross-entropy above the mean by so many standard errors and so much more (nats a letter).
ERRORS, MARGIN = 6.0, 0.5
UNKNOWN = "und"


def runs_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def gram_codes(runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(4-gram codes of all runs, number of codes of each run). 16 bits for a letter, mark 0 at the ends.

    Letters beyond 16 bits are folded into them.
    """
    lengths = np.fromiter(map(len, runs), np.int64, len(runs))
    joined = np.frombuffer("".join(runs).encode("utf-32-le", "replace"), np.uint32)
    letters = (joined ^ (joined >> np.uint32(16))).astype(np.uint64) & np.uint64(0xFFFF)
    # Each run becomes 3 marks, its letters, 1 mark.
    ends = np.cumsum(lengths + ORDER)
    padded = np.zeros(int(ends[-1]) if len(runs) else 0, np.uint64)
    starts = ends - lengths - 1
    places = np.arange(len(letters)) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    padded[places] = letters
    codes = padded[: max(0, len(padded) - ORDER + 1)].copy()
    for i in range(1, ORDER):
        codes <<= np.uint64(16)
        codes |= padded[i : i + len(codes)]
    inside = np.ones(len(codes), bool)  # codes that reach into the next run
    for i in range(ORDER - 1):
        cut = ends[:-1] - 1 - i
        inside[cut] = False
    return codes[inside], lengths + 1


def learning(docs: DataFrame) -> Column:
    """Rows to learn from: with a language and an id that is not held out."""
    return F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of docs (text, lang)."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in chunks(frames):
            for lang, part in frame.groupby("lang"):
                words = Counter(chain.from_iterable(map(runs_of, part["text"])))
                if not words:
                    continue
                codes, sizes = gram_codes(list(words))
                weights = np.repeat(np.fromiter(words.values(), np.int64, len(words)), sizes)
                grams, place = np.unique(codes, return_inverse=True)
                n = np.bincount(place, weights).astype(np.int64)
                yield pd.DataFrame({"lang": lang, "gram": grams.view(np.int64), "n": n})

    counted = docs.select("text", "lang").mapInPandas(count, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def lower_counts(counts: DataFrame, length: int) -> DataFrame:
    """(lang, gram, n) of the order below that of the counts' length: numbers of distinct left neighbours."""
    gram = F.col("gram").bitwiseAND((1 << 16 * (length - 1)) - 1)
    return counts.groupBy("lang", gram.alias("gram")).agg(F.count("*").alias("n"))


def _block_key() -> Column:
    """A gram's third letter (the last but one) above its second."""
    letter = lambda bits: F.shiftrightunsigned("gram", bits).bitwiseAND(0xFFFF)
    return letter(16) * (1 << 16) + letter(32)


def _discount(once: float, twice: float) -> float:
    return float(np.clip(once / (once + 2 * twice) if once else 0.5, 0.1, 0.95))


class _Order:
    """Discounted counts of one order of one language, in sorted arrays."""

    def __init__(self, length: int, grams: np.ndarray, n: np.ndarray, discount: float | None = None):
        self.length, self.grams, self.n = length, grams, n.astype(float)
        self.discount = _discount((n == 1).sum(), (n == 2).sum()) if discount is None else discount
        self.contexts, first, distinct = np.unique(grams >> np.uint64(16), return_index=True, return_counts=True)
        self.total = np.add.reduceat(self.n, first) if len(first) else np.empty(0)
        self.distinct = distinct.astype(float)

    def below(self) -> tuple[np.ndarray, np.ndarray]:
        """Grams of the order below with their numbers of distinct left neighbours."""
        bits = np.uint64(16 * (self.length - 1))
        return np.unique(self.grams & ((np.uint64(1) << bits) - np.uint64(1)), return_counts=True)

    def mixed(self, grams: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probability of each gram's last letter, given those of the order below."""
        n, contexts = _found(self.grams, self.n, grams), grams >> np.uint64(16)
        total, distinct = _found(self.contexts, self.total, contexts), _found(self.contexts, self.distinct, contexts)
        known = total > 0
        whole = np.where(known, total, 1.0)
        return np.where(known, (np.maximum(n - self.discount, 0) + self.discount * distinct * lower) / whole, lower)


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, values[place], 0.0)


class LetterModel:
    """Probabilities of one language."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, letters: int, below: dict | None = None, discounts: dict | None = None):
        """below: (grams, n) by length and discounts by length, if grams are not all of the language's."""
        self.letters, self.orders = letters, []
        for length in range(ORDER, 0, -1):
            order = _Order(length, grams, n, None if discounts is None else discounts.get(length, 0.5))
            self.orders.append(order)
            if length > 1:
                grams, n = order.below() if below is None else below[length - 1]

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        p = np.full(len(grams), 1.0 / self.letters)
        for order in reversed(self.orders):
            mask = np.uint64(0xFFFFFFFFFFFFFFFF >> (64 - 16 * order.length))
            p = order.mixed(grams & mask, p)
        return np.log(p)


def _sorted_counts(counts: pd.DataFrame, lang: str) -> tuple[np.ndarray, np.ndarray]:
    own = counts[counts["lang"] == lang]
    grams = own["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(grams)
    return grams[order], own["n"].to_numpy(np.int64)[order]


class Block:
    """All languages' probabilities of the grams with keys in low to high - 1, ready for scoring."""

    def __init__(self, langs: list[str], letters: int, counts: dict[int, pd.DataFrame], discounts: dict, low: int = 0, high: int = 1 << 32):
        self.langs, self.low, self.high = langs, low, high
        self.models = []
        for lang in langs:
            orders = {length: _sorted_counts(part, lang) for length, part in counts.items()}
            self.models.append(LetterModel(*orders[ORDER], letters, orders, discounts[lang]))
        self.grams = np.unique(counts[ORDER]["gram"].to_numpy(np.int64).view(np.uint64))
        self.rows = self._rows(self.grams)

    def _rows(self, grams: np.ndarray) -> np.ndarray:
        rows = [m.log_probabilities(grams) for m in self.models]
        return np.stack(rows, axis=1).astype(np.float32) if rows else np.empty((len(grams), 0), np.float32)

    def run_scores(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log probability of each run's grams of this block under each language, letters read)."""
        codes, sizes = gram_codes(runs)
        every = codes
        whole = self.low == 0 and self.high == 1 << 32
        if not whole:
            letter = np.uint64(0xFFFF)
            keys = (codes & (letter << np.uint64(16))) | (codes >> np.uint64(32) & letter)
            own = (keys >= np.uint64(self.low)) & (keys < np.uint64(self.high))
            codes = codes[own]
        if len(self.grams):
            place = np.minimum(np.searchsorted(self.grams, codes), len(self.grams) - 1)
            rows = self.rows[place]
            new = np.flatnonzero(self.grams[place] != codes)
        else:
            rows, new = np.empty((len(codes), len(self.langs)), np.float32), np.arange(len(codes))
        if len(new):
            grams, back = np.unique(codes[new], return_inverse=True)
            rows[new] = self._rows(grams)[back]
        if not whole:
            part, rows = rows, np.zeros((len(every), len(self.langs)), np.float32)
            rows[own] = part
        return np.add.reduceat(rows, np.cumsum(sizes) - sizes, axis=0), sizes

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log probability of this block's grams of each text under each language, letters read)."""
        split = [runs_of(t) for t in texts]
        number = {run: i for i, run in enumerate(dict.fromkeys(chain.from_iterable(split)))}
        sums, letters = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        if not number or not self.langs:
            return sums, letters
        scores, sizes = self.run_scores(list(number))
        for i, runs in enumerate(split):
            if runs:
                places = np.fromiter(map(number.__getitem__, runs), np.int64, len(runs))
                letters[i] = sizes[places].sum()
                sums[i] = scores[places].sum(axis=0, dtype=float)
        return sums, letters


class Judge:
    """The language and the rejection that a text's sums lead to."""

    def __init__(self, langs: list[str]):
        self.langs = langs
        self.mean = np.zeros(len(langs))
        self.sd = np.full(len(langs), np.inf)

    def predict(self, texts: list[str], sums: np.ndarray, letters: np.ndarray) -> pd.DataFrame:
        if not self.langs:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0, "rejected": True})
        means = sums / np.maximum(letters, 1)[:, None]
        best = means.argmax(axis=1)
        top = means[np.arange(len(texts)), best]
        weight = np.minimum(letters, 30)[:, None]
        score = 1 / np.exp((means - top[:, None]) * weight).sum(axis=1)
        limit = self.mean[best] + ERRORS * self.sd[best] / np.sqrt(np.maximum(letters, 1)) + MARGIN
        known = np.array([n > 0 and any(map(str.isalpha, t)) for n, t in zip(letters, texts, strict=True)], bool)
        return pd.DataFrame(
            {
                "lang_pred": np.where(known, np.array(self.langs, object)[best], UNKNOWN),
                "score": np.where(known, score, 0.0),
                "rejected": ~known | (-top > limit),
            }
        )


class LanguageModels:
    """Counts of all languages in tables of Spark, the ranges of their blocks, and the judge.

    The driver holds the counts of single letters, the discounts and one block at a time.
    """

    def __init__(self, counts: DataFrame, block_grams: int = BLOCK_GRAMS):
        self.tables = {ORDER: stored(counts.withColumn("key", _block_key()), "grams-4")}
        for length in range(ORDER, 1, -1):
            lower = lower_counts(self.tables[length], length).withColumn("key", _block_key())
            self.tables[length - 1] = stored(lower, f"grams-{length - 1}")
        self.singles = self.tables.pop(1).toArrow().to_pandas()
        self.langs = sorted(self.singles["lang"].unique())
        self.letters = self.singles["gram"].nunique() + 1
        self.discounts: dict[str, dict[int, float]] = {lang: {} for lang in self.langs}
        for length, table in [*self.tables.items(), (1, None)]:
            if table is None:
                ones = [(lang, (n == 1).sum(), (n == 2).sum()) for lang, n in self.singles.groupby("lang")["n"]]
            else:
                ones = table.groupBy("lang").agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).collect()
            for lang, once, twice in ones:
                self.discounts[lang][length] = _discount(once, twice)
        self.ranges = self._cut(block_grams)
        if len(self.ranges) > 1:
            for length, table in self.tables.items():
                spread = table.repartitionByRange(tasks(table.sparkSession), "key").sortWithinPartitions("key")
                self.tables[length] = stored(spread, f"blocks-{length}")
        self.judge = Judge(self.langs)

    def _cut(self, block_grams: int) -> list[tuple[int, int]]:
        """Ranges of keys with at most so many counts; one key with more has its own."""
        counts, third = self.tables[ORDER], F.shiftright("key", 16)
        sizes = counts.groupBy(third.alias("k")).count().toPandas().sort_values("k")
        if sizes["count"].sum() <= block_grams:
            return [(0, 1 << 32)]
        cuts, held = [0], 0
        for k, n in zip(sizes["k"].tolist(), sizes["count"].tolist(), strict=True):
            parts = [(k << 16, n)]
            if n > block_grams:
                parts = sorted(map(tuple, counts.where(third == k).groupBy("key").count().collect()))
            for key, m in parts:
                if held and held + m > block_grams:
                    cuts.append(key)
                    held = 0
                held += m
        return list(zip(cuts, [*cuts[1:], 1 << 32], strict=True))

    def block(self, low: int, high: int) -> Block:
        """A block's counts. Of letter pairs it takes all that begin with one of its third letters."""
        inside = {length: (F.col("key") >= low) & (F.col("key") < high) for length in (4, 3)}
        inside[2] = F.col("key").between(low >> 16 << 16, high - 1 | 0xFFFF)
        parts = {k: self.tables[k].where(inside[k]).select("lang", "gram", "n").toArrow().to_pandas() for k in (4, 3, 2)}
        return Block(self.langs, self.letters, parts | {1: self.singles}, self.discounts, low, high)

    @cached_property
    def only(self) -> Block:
        """The block of models that have only one."""
        (bounds,) = self.ranges
        return self.block(*bounds)

    @property
    def grams(self) -> np.ndarray:
        """All 4-grams, block by block, and the rows of their log probabilities."""
        return np.concatenate([self.block(*bounds).grams for bounds in self.ranges])

    @property
    def rows(self) -> np.ndarray:
        return np.concatenate([self.block(*bounds).rows for bounds in self.ranges])

    def summed(self, docs: DataFrame) -> DataFrame:
        """(text_key, sums, letters) of the distinct texts, from all blocks one after another."""
        texts = docs.select(F.xxhash64("text").alias("text_key"), "text")
        fields = [f"s{i}" for i in range(len(self.langs))]
        parts = []
        for bounds in self.ranges:
            shared = docs.sparkSession.sparkContext.broadcast(self.block(*bounds))
            found = texts.mapInPandas(_partial(shared, fields), ", ".join(["text_key bigint", "letters bigint", *(f"{f} double" for f in fields)]))
            parts.append(stored(found.dropDuplicates(["text_key"]), "block-sums"))
            shared.destroy()
        added = reduce(DataFrame.unionByName, parts).groupBy("text_key").agg(F.max("letters").alias("letters"), *(F.sum(f).alias(f) for f in fields))
        return stored(added.select("text_key", F.array(*fields).alias("sums"), "letters"), "sums")


def _partial(shared, fields: list[str]):
    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in chunks(frames):
            sums, letters = shared.value.sums(list(frame["text"]))
            rows = pd.DataFrame(sums, columns=fields)
            yield rows.assign(text_key=frame["text_key"].to_numpy(), letters=letters)[["text_key", "letters", *fields]]

    return score


def _judged(docs: DataFrame, models: LanguageModels, make, fields: str, columns: list[str]) -> DataFrame:
    """docs with what make says of (texts, sums, letters, values of columns)."""
    if len(models.ranges) == 1:
        shared = docs.sparkSession.sparkContext.broadcast(models.only)
        return appended(docs, ["text", *columns], lambda texts, *more: make(texts, *shared.value.sums(texts), *more), fields)
    known = models.summed(docs).withColumnsRenamed({"text_key": "_text_key", "sums": "_sums", "letters": "_letters"})
    met = docs.withColumn("_text_key", F.xxhash64("text")).join(known, "_text_key", "left")
    arrays = lambda texts, sums, letters, *more: make(texts, np.array(sums, float), np.array(letters, np.int64), *more)
    return appended(met, ["text", "_sums", "_letters", *columns], arrays, fields).drop("_text_key", "_sums", "_letters")


def learn(docs: DataFrame, block_grams: int = BLOCK_GRAMS, rows: Column | None = None) -> LanguageModels:
    """Models of all languages in docs (doc_id, text, lang), from all rows that `learning` allows, or all with a language that `rows` does.

    The same rows, all of them, calibrate the rejection: Spark scores them and adds up their moments by language.
    """
    bounded_batches(docs.sparkSession)
    wanted = learning(docs) if rows is None else rows & F.col("lang").isNotNull()
    allowed = docs.where(wanted & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    models = LanguageModels(gram_counts(allowed), block_grams)
    langs, judge = models.langs, models.judge

    def measure(texts: list[str], sums: np.ndarray, letters: np.ndarray, own: list[str]) -> list:
        """Cross-entropy of each text under its own language."""
        k = np.array([langs.index(x) if x in langs and n else -1 for x, n in zip(own, letters, strict=True)])
        return [k, letters, -sums[np.arange(len(k)), k] / np.maximum(letters, 1)]

    if langs:
        measured = _judged(allowed, models, measure, "k bigint, n bigint, cross double", ["lang"]).where("k >= 0")
        weight, cross = F.col("n").cast("double"), F.col("cross")
        sums = [F.sum(x) for x in (weight, weight * cross, weight * cross * cross)]
        for k, rows, whole, first, second in measured.groupBy("k").agg(F.count("*"), *sums).collect():
            judge.mean[k] = mean = first / whole
            # mean of n * (cross - mean) ** 2; n of up to 10 digits leave 6 of a double
            judge.sd[k] = np.sqrt(max(0.0, second - 2 * mean * first + mean * mean * whole) / rows) + 0.5
    return models


def identify(docs: DataFrame, models: LanguageModels) -> DataFrame:
    """docs with lang_pred, score and rejected (columns of these names are replaced).

    A null text, or one without a letter, is `und` with score 0 and rejected. Without learned
    languages every text is. Equally likely languages: the first by name. Repeated rows are judged
    each; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    judge = models.judge

    def predict(texts: list[str], sums: np.ndarray, letters: np.ndarray) -> list:
        found = judge.predict(texts, sums, letters)
        return [found["lang_pred"].to_list(), found["score"].to_numpy(), found["rejected"].to_numpy()]

    return _judged(docs, models, predict, "lang_pred string, score double, rejected boolean", [])
