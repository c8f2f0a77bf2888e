"""Collocations by Toivonen's method: phrases that are frequent in a sample, and their border, counted exactly.

A phrase of k words can only be frequent if its first and its last k - 1 words are. A sample proposes
phrases of up to 3 words at a lowered threshold. A pass over all texts then counts every word, and
every longer phrase whose two parts are proposed: these are the proposed phrases and their negative
border. Where a phrase of the border turns out frequent, its extensions may be frequent too and were
not counted, so it joins the proposed ones, and a further pass counts what has become countable. The
passes end when no phrase of the border is frequent, and then no frequent phrase is missing.

Proposed phrases reach the tasks as bits of a filter of bounded size. What it passes beside them is
counted needlessly, and still exactly. Passes carry 64-bit hashes of phrases, and with each the smallest
key of a row that holds it; at last these rows name their phrases. Results are exact up to 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymark.llm.shared import BASE, byte_set, hashed_words, mixed, stored

#: Words of the longest phrase.
LONGEST = 4
#: One row in so many, by a hash of its columns, is in the sample.
SAMPLE = 4
#: What a phrase must reach in the sample, as a share of what its threshold would be there.
LOWERED = 0.4
#: Bits of the filter of proposed phrases for each of them, and at most in all (32 MB).
BITS_EACH, MAX_BITS = 16, 1 << 28
#: Counts that a task holds before it hands them on.
HELD = 3 << 19
#: Characters of texts read together.
CHARS = 1 << 20

_SPACES = byte_set(b" .")
#: Lower-cases A-Z, turns tabs into spaces and what ends a piece into full stops.
_FOLD = bytearray(range(256))
for _b in range(65, 91):
    _FOLD[_b] += 32
for _b in b",;:!?\n\x0b\x0c\r":
    _FOLD[_b] = 0x2E
_FOLD[0x09] = 0x20
_FOLD = bytes(_FOLD)


class Proposed:
    """Filter of phrase hashes: passes all that were put in, and some others."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 64 - 1)

    def passes(self, keys: np.ndarray) -> np.ndarray:
        held = np.ones(len(keys), bool)
        for shift in (np.uint64(2), np.uint64(30)):
            slot = (keys >> shift) & self.mask
            held &= (self.bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
        return held


class Passage:
    """Words of some texts of one language, as hashes, with their places and the number of their text."""

    def __init__(self, texts: list[str], lang: str):
        encoded = [t.encode() for t in texts]
        self.text = b".".join(encoded).translate(_FOLD)
        begins = np.cumsum([0] + [len(t) + 1 for t in encoded[:-1]])
        data = np.frombuffer(self.text, np.uint8)
        edges = np.flatnonzero(np.diff(~_SPACES[data], prepend=False, append=False))
        self.starts, self.ends = edges[::2], edges[1::2]
        pieces = np.searchsorted(np.flatnonzero(data == 0x2E), self.starts)
        salt = np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))
        self.words = mixed(hashed_words(self.text, _SPACES) ^ salt)
        #: Stands for all words of the language together.
        self.all_words = mixed(np.array([salt ^ BASE], np.uint64))[0] & ~np.uint64(3)
        self.texts = np.searchsorted(begins, self.starts, "right") - 1
        #: How many words follow in the same piece, as far as it matters.
        self.joined = np.zeros(len(self.words), np.int8)
        for k in range(1, min(LONGEST, len(self.words))):
            self.joined[:-k] += pieces[k:] == pieces[:-k]

    def level(self, k: int, shorter: np.ndarray | None) -> np.ndarray:
        """Hash of the k words from each place, with k - 1 in its last two bits; the places near an end hold no phrase."""
        if k == 1:
            return self.words & ~np.uint64(3)
        n = max(len(self.words) - k + 1, 0)
        longer = mixed(shorter[:n] * BASE + self.words[k - 1 : k - 1 + n])
        return longer & ~np.uint64(3) | np.uint64(k - 1)

    def phrases(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(k, hashes by place, places where k words stand in one piece) for every k."""
        found = None
        for k in range(1, LONGEST + 1):
            found = self.level(k, found)
            yield k, found, np.flatnonzero(self.joined[: len(found)] >= k - 1)


def countable(passage: Passage, proposed: Proposed | None, before: Proposed | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, places) of all occurrences of phrases to count: all without filters, else those whose parts are proposed.

    With `before`, those that its filter had let count are left out.
    """
    parts, earlier = None, None
    for k, found, places in passage.phrases():
        if proposed is None:
            if k < LONGEST:
                yield found[places], places
            continue
        if k == 1:
            if before is None:
                yield found, places
        else:
            held = parts[places] & parts[places + 1]
            if before is not None:
                held &= ~(earlier[places] & earlier[places + 1])
            places = places[held]
            yield found[places], places
        if k < LONGEST:
            parts = proposed.passes(found)
            earlier = before.passes(found) if before is not None else None


def _passages(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[str, Passage, list]]:
    """Texts of a task by language, about CHARS characters at a time, with what another column holds for them."""
    held: dict[str, list] = {}
    sizes: dict[str, int] = {}

    def taken(lang: str) -> tuple[str, Passage, list]:
        del sizes[lang]
        rows = held.pop(lang)
        return lang, Passage([t for t, _ in rows], lang), [x for _, x in rows]

    for batch in batches:
        for lang, text, other in zip(batch.column(0), batch.column(1), batch.column(column)):
            lang, text = lang.as_py(), text.as_py()
            held.setdefault(lang, []).append((text, other.as_py()))
            sizes[lang] = sizes.get(lang, 0) + len(text)
            if sizes[lang] >= CHARS:
                yield taken(lang)
            elif len(held) > 64:
                yield taken(max(sizes, key=sizes.__getitem__))
    for lang in list(held):
        yield taken(lang)


COUNTS = "h bigint, n bigint, row bigint"


def _counted(texts: DataFrame, proposed, before) -> DataFrame:
    """Hash and count of all phrases to count, and the smallest key of a row with it, over all rows (lang, text, row)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        whole: list[tuple[int, int, int]] = []
        size = 0

        def counts() -> pa.RecordBatch:
            h, rows = (np.concatenate(x) for x in zip(*held)) if held else (np.empty(0, np.uint64), np.empty(0, np.int64))
            order = np.argsort(h)
            h = h[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
            n = np.diff(np.append(first, len(h)))
            least = np.minimum.reduceat(rows[order], first) if len(h) else rows
            more = np.array(whole, np.int64).reshape(-1, 3)
            parts = (h[first].view(np.int64), more[:, 0]), (n, more[:, 1]), (least, more[:, 2])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in parts], names=["h", "n", "row"])

        for _, passage, keys in _passages(batches, 2):
            rows = np.array(keys, np.int64)[passage.texts]
            for found, places in countable(passage, proposed and proposed.value, before and before.value):
                held.append((found, rows[places]))
                size += len(found)
            if proposed is not None and before is None and len(rows):
                whole.append((int(passage.all_words.view(np.int64)), len(rows), int(rows.min())))
            if size >= HELD:
                yield counts()
                held, whole, size = [], [], 0
        yield counts()

    return texts.mapInArrow(count, COUNTS).groupBy("h").agg(F.sum("n").alias("n"), F.min("row").alias("row"))


def _filter(hashes: DataFrame):
    """Broadcast filter of stored hashes; its size follows their number up to a bound."""
    bits = min(max(1 << (BITS_EACH * hashes.count() - 1).bit_length() if hashes.count() else 64, 1 << 12), MAX_BITS)
    slots = F.explode(F.array(*(F.shiftrightunsigned("h", s).bitwiseAND(bits - 1) for s in (2, 30))))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("slot").bitwiseAND(63).cast("int"))
    words = hashes.select(slots.alias("slot")).groupBy(F.shiftrightunsigned("slot", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found, table = words.toArrow(), np.zeros(bits // 64, np.int64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return hashes.sparkSession.sparkContext.broadcast(Proposed(table.view(np.uint64)))


def _missing(known):
    @F.pandas_udf("boolean")
    def missing(h: pd.Series) -> pd.Series:
        return pd.Series(~known.value.passes(h.to_numpy(np.int64).view(np.uint64)))

    return missing


def frequent_hashes(texts: DataFrame, least: int, sample: int = SAMPLE) -> DataFrame:
    """(h, n, row) of all words and phrases that occur `least` times in texts (lang, text, row), and of each language's words together.

    The sample is drawn by the keys of the rows.
    """
    drawn = texts.where(F.pmod("row", F.lit(sample)) == 0)
    lowered = max(1, int(least / sample * LOWERED))
    proposed = stored(_counted(drawn, None, None).where(F.col("n") >= lowered).select("h"), "proposed")
    known, before, found = _filter(proposed), None, None
    while True:
        fresh = stored(_counted(texts, known, before).where(F.col("n") >= least), "frequent")
        found = fresh if found is None else found.unionByName(fresh)
        # Frequent phrases of the border that others can extend.
        failed = fresh.where(F.col("h").bitwiseAND(3) < LONGEST - 1).where(_missing(known)("h")).select("h")
        failed = stored(failed, "border-failures")
        if failed.isEmpty():
            return found
        proposed = stored(proposed.unionByName(failed), "proposed")
        known, before = _filter(proposed), known


NAMED = "h bigint, lang string, phrase string, k int"


def frequent_phrases(texts: DataFrame, least: int, sample: int = SAMPLE) -> DataFrame:
    """Counts of all words and phrases (lang, phrase, k, n) that occur `least` times; n of all words as k = 0.

    texts has lang and text; its further columns only tell copies of a text apart.
    """
    keyed = texts.select("lang", "text", F.xxhash64(*texts.columns).alias("row"))
    known = stored(frequent_hashes(keyed, least, sample), "frequent")
    # A row names only phrases that it holds, so a list is no longer than its text.
    naming = known.groupBy("row").agg(F.collect_list("h").alias("hashes"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, passage, wanted in _passages(batches, 2):
            # A hash and a text's number in one; both of a wanted phrase meet at its places only.
            tied = mixed(np.arange(1, len(wanted) + 1, dtype=np.uint64))
            lists = [np.array(w, np.int64).view(np.uint64) for w in wanted]
            keys = np.sort(np.concatenate(lists) ^ np.repeat(tied, [len(w) for w in lists]))
            out: dict[int, tuple[str, int]] = {}
            if (np.concatenate(lists) == passage.all_words).any():
                out[int(passage.all_words.view(np.int64))] = "", 0
            for k, found, places in passage.phrases():
                at = found[places] ^ tied[passage.texts[places]]
                place = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
                places = places[keys[place] == at]
                h, first = np.unique(found[places], return_index=True)
                places = places[first]
                for x, a, b in zip(h.view(np.int64).tolist(), passage.starts[places].tolist(), passage.ends[places + k - 1].tolist()):
                    out[x] = b" ".join(w for w in passage.text[a:b].split(b" ") if w).decode(), k
            rows = [(h, lang, phrase, k) for h, (phrase, k) in out.items()]
            columns = list(zip(*rows)) or [[]] * 4
            kinds = pa.int64(), pa.string(), pa.string(), pa.int32()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["h", "lang", "phrase", "k"])

    holders = keyed.join(naming, "row").select("lang", "text", "hashes")
    named = holders.mapInArrow(name, NAMED).distinct()
    return stored(named.join(known.select("h", "n"), "h").select("lang", "phrase", "k", "n"), "frequent-phrases")


def _decimal(column: str):
    return F.col(column).cast("decimal(38,0)")


def mine(docs: DataFrame, least: int = 30, covered: int = 80, top: int | None = 2000, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """Phrases of 2 to 4 words by language: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased, texts are split at `.,;:!?` and line ends into pieces and those at spaces and
    tabs into words; phrases stay inside a piece. a counts a phrase (at least `least`), n all words of the
    language; l and r count the two parts of the cut with the lowest score floor(2000000 * a / (l + r)), the
    earliest of these. A phrase inside a longer candidate with covered % of its count is left out. The
    `top` best of each language by score, a (both falling) and phrase are returned, or all for None.
    Counts are those of 64-bit hashes of the phrases. A null text is empty, a null language `und`; repeated rows count each; other columns are left
    out, whatever their names; a table without frequent phrases gives no rows.
    """
    body = [F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")]
    known = frequent_phrases(docs.select(*body, *_others(docs, text, lang)), least, sample)
    return ranked(known, covered, top)


def _others(docs: DataFrame, text: str, lang: str) -> list:
    """Further plain columns, so that copies of a text are not all in the sample or all out of it."""
    plain = ("string", "bigint", "int", "double")
    return [F.col(f"`{c}`").alias(f"_{i}") for i, (c, kind) in enumerate(docs.dtypes) if kind in plain and c not in (text, lang)]


def ranked(known: DataFrame, covered: int = 80, top: int | None = 2000) -> DataFrame:
    """Candidates of exact counts with their scores, without those that longer ones cover."""
    counts = known.where("k > 0").select("lang", "phrase", "k", F.col("n").alias("a"))
    words = F.split("phrase", " ", -1)
    candidates = counts.where("k > 1").withColumn("words", words)

    part = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right")
    )
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    whole = "CAST({} AS DECIMAL(19,0))".format
    score = F.expr(f"CAST(2000000 AS DECIMAL(7,0)) * {whole('a')} DIV ({whole('l')} + {whole('r')})")
    scored = scored.withColumn("score", score)
    best = scored.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("best")
    )

    spans = F.expr(
        "flatten(transform(sequence(2, k - 1), w -> transform(sequence(1, k - w + 1), s -> array_join(slice(words, s, w), ' '))))"
    )
    inner = candidates.where("k > 2").select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), F.col("a").alias("longer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (_decimal("longer") * 100 < _decimal("a") * covered)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), F.asc("phrase"))
    if top is not None:
        kept = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    else:
        kept = kept.withColumn("rank", F.row_number().over(order))
    totals = known.where("k = 0").select("lang", "n")
    return kept.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint"), "phrase", "a", "best.l", "best.r", "n", F.col("best.score").cast("bigint").alias("score")
    )
