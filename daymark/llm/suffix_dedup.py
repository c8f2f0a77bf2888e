"""Suffix-array dedup: a logarithmic family of sparse suffix arrays finds repeated 200-byte strings.

A suffix array of every byte would be many times larger than the text. Of each 200-byte window only
the suffix at one anchor is kept: the 40 bytes in it with the smallest hash. Equal windows choose
equal anchors at equal places, so every repeated window shows as a repeated anchor, and one
in about 80 suffixes is an anchor. An array lists the anchors of a batch of documents in the order
of the fingerprint of their first bytes. A new batch's array is merge-scanned with the arrays of
all levels for anchors that occur twice, then it becomes a level; two levels of one size merge
into a level of the next, so a batch is rewritten only logarithmically often.

Repeated anchors are then extended. An anchor stands for a run of neighbouring windows. Anchors
whose whole runs are equal (one class) settle all their windows at once. Where an anchor has several
classes, the windows of one sample of each class are compared one by one. At last each text that can
hold repeats meets the windows found, and bytes inside any of them are covered.

Anchors, classes and windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.shared import MIX_A, appended, chunks, key_filter, mixed, passing, stored

LENGTH = 200
ANCHOR = 40
BATCHES = 4
#: Windows hashed at a time: longer texts are cut into parts that overlap by a window.
PART = 1 << 20
#: Classes whose windows are compared in one group; anchors with more of them are compared by a shuffle of windows.
GROUP_CLASSES = 4096
HOT_CLASSES = 16384

_FACTOR = MIX_A | np.uint64(1)
#: Low bits that hold a place in a part.
_PLACE = np.uint64(2 * PART - 1)


@lru_cache(maxsize=1)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's factor and of its inverse."""
    inverse = pow(int(_FACTOR), -1, 1 << 64)
    out = []
    for base in (_FACTOR, np.uint64(inverse)):
        powers = np.full(length, base, np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers, dtype=np.uint64))
    return out[0], out[1]


class Part:
    """Anchors of a part of a text: for each one the windows [low, high] that choose it."""

    def __init__(self, data: np.ndarray, length: int, anchor: int):
        up, self.down = _powers(PART + 4096)
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=self.sums[1:])
        hashes = self.span(np.arange(n - anchor + 1), anchor)
        # High bits of the hash, then the place: the first of equals wins, and each key is one place.
        best = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        width, step = length - anchor + 1, 1
        while 2 * step <= width:
            best = np.minimum(best[:-step], best[step:])
            step *= 2
        if width > step:
            best = np.minimum(best[: step - width], best[width - step :])
        self.low = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
        self.high = np.concatenate([self.low[1:], [len(best)]]) - 1
        self.anchors = hashes[(best[self.low] & _PLACE).view(np.int64)]
        runs = self.high - self.low
        self.classes = mixed(self.span(self.low, runs + length) + runs.astype(np.uint64))

    def span(self, start: np.ndarray, size) -> np.ndarray:
        """Hashes of the bytes from each start on."""
        return mixed((self.sums[start + size] - self.sums[start]) * self.down[start])


def parts(text: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> Iterator[tuple[int, Part]]:
    """(first byte, part) of a text; nothing for texts below a window."""
    data = np.frombuffer(text, np.uint8)
    for first in range(0, len(data) - length + 1, PART):
        yield first, Part(data[first : first + PART + length - 1], length, anchor)


class SuffixFamily:
    """Levels of sparse suffix arrays, in tables in the shared folder.

    add() takes a batch of texts, gives the anchors that it repeats (in itself or in any level)
    and makes its array a level.
    """

    def __init__(self, length: int = LENGTH, anchor: int = ANCHOR):
        self.length, self.anchor, self.levels = length, anchor, {}

    def array(self, batch: DataFrame) -> DataFrame:
        """(anchor, n): the batch's anchors in order, n is 2 for those that occur more than once."""
        length, anchor = self.length, self.anchor

        def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in chunks(frames):
                found = [p.anchors for t in frame["text"] for _, p in parts(t.encode(), length, anchor)]
                if found:
                    keys, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pd.DataFrame({"anchor": keys.view(np.int64), "n": np.minimum(n, 2)})

        return _counted(batch.select("text").mapInPandas(cut, "anchor bigint, n bigint"))

    def add(self, batch: DataFrame) -> DataFrame:
        """(anchor): anchors of the batch that occur twice or more, counting all levels."""
        array = stored(self.array(batch).sortWithinPartitions("anchor"), "suffixes")
        repeated = array.where("n > 1").select("anchor")
        for level in self.levels.values():
            repeated = repeated.union(array.join(level.select("anchor"), "anchor").select("anchor"))
        size = 0
        while size in self.levels:
            array = stored(_counted(array.union(self.levels.pop(size))).sortWithinPartitions("anchor"), "suffixes")
            size += 1
        self.levels[size] = array
        return repeated


def _counted(anchors: DataFrame) -> DataFrame:
    return anchors.groupBy("anchor").agg(F.least(F.sum("n"), F.lit(2)).alias("n"))


def _classes(texts: DataFrame, known, length: int, anchor: int) -> DataFrame:
    """(anchor, class_id, n) of all anchors that pass the filter."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in chunks(frames):
            found = []
            for text in frame["text"]:
                for _, p in parts(text.encode(), length, anchor):
                    held = known.value.passes(p.anchors)
                    found.append(pd.DataFrame({"anchor": p.anchors[held].view(np.int64), "class_id": p.classes[held].view(np.int64)}))
            if found:
                yield pd.concat(found).value_counts().rename("n").reset_index()

    counted = texts.mapInPandas(cut, "anchor bigint, class_id bigint, n bigint")
    return counted.groupBy("anchor", "class_id").agg(F.sum("n").alias("n"))


def _samples(texts: DataFrame, known, length: int, anchor: int) -> DataFrame:
    """(class_id, data): the bytes of one run of each class that passes the filter."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for frame in chunks(frames):
            rows = {}
            for text in frame["text"]:
                data = text.encode()
                for first, p in parts(data, length, anchor):
                    for i in np.flatnonzero(known.value.passes(p.classes)).tolist():
                        key = int(p.classes[i].view(np.int64))
                        if key not in seen:
                            rows[key] = data[first + p.low[i] : first + p.high[i] + length]
            if len(seen) > 1_000_000:
                seen.clear()
            seen.update(rows)
            if rows:
                yield pd.DataFrame({"class_id": list(rows.keys()), "data": list(rows.values())})

    return texts.mapInPandas(cut, "class_id bigint, data binary").dropDuplicates(["class_id"])


def window_hashes(data: bytes, length: int) -> np.ndarray:
    up, down = _powers(PART + 4096)
    values = np.frombuffer(data, np.uint8)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    n = len(values) - length + 1
    return mixed((sums[length:] - sums[:n]) * down[:n])


def _compare(length: int):
    """Windows of a group of samples that two classes of one anchor share: (class_id, windows as bits)."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        hashed = [window_hashes(d, length) + np.uint64(a) for d, a in zip(frame["data"], frame["anchor"].to_numpy().view(np.uint64), strict=True)]
        if not hashed:
            return pd.DataFrame({"class_id": [], "bits": []})
        # A class never holds one window twice at different places of its run and one anchor.
        _, place, n = np.unique(np.concatenate(hashed), return_inverse=True, return_counts=True)
        cuts = np.cumsum([len(h) for h in hashed])[:-1]
        twice = np.split(n[place] > 1, cuts)
        out = [(key, np.packbits(t).tobytes()) for key, t in zip(frame["class_id"], twice, strict=True) if t.any()]
        return pd.DataFrame(out, columns=["class_id", "bits"])

    return compare


def _compare_hot(samples: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many classes: windows are shuffled by their hashes."""

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, anchor, data in zip(frame["class_id"], frame["anchor"], frame["data"], strict=True):
                h = window_hashes(data, length) + np.array([anchor], np.int64).view(np.uint64)
                yield pd.DataFrame({"hash": h.view(np.int64), "class_id": key, "place": np.arange(len(h)), "total": len(h)})

    windows = samples.mapInPandas(spread, "hash bigint, class_id bigint, place int, total int")
    twice = windows.groupBy("hash").agg(F.min("class_id").alias("a"), F.max("class_id").alias("b")).where("a <> b").select("hash")
    found = windows.join(twice, "hash").groupBy("class_id").agg(F.collect_set("place").alias("places"), F.first("total").alias("total"))
    bit = lambda i: F.when(F.array_contains("places", i), "1").otherwise("0")
    shown = F.array_join(F.transform(F.sequence(F.lit(0), F.col("total") - 1), bit), "")
    padded = F.rpad(shown, F.expr("cast(ceil(total / 8) * 8 as int)"), F.lit("0"))
    # Bits in groups of four as hexadecimal digits.
    hexed = F.transform(F.sequence(F.lit(1), F.length(padded), F.lit(4)), lambda i: F.conv(F.substring(padded, i, F.lit(4)), 2, 16))
    return found.select("class_id", F.unhex(F.array_join(hexed, "")).alias("bits"))


def repeated_windows(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, batches: int = BATCHES, hot: int = HOT_CLASSES) -> DataFrame:
    """(class_id, bits) of runs with repeated windows; bits is null where all of them are."""
    texts = docs.where(F.octet_length("text") >= length).select("text")
    family, repeated = SuffixFamily(length, anchor), None
    for batch in range(batches):
        found = family.add(texts.where(F.pmod(F.xxhash64("text", F.lit(3)), F.lit(batches)) == batch))
        repeated = found if repeated is None else repeated.union(found)
    classes = stored(_classes(texts, key_filter(stored(repeated, "repeated"), "anchor"), length, anchor), "run-classes")
    several = classes.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1")
    open_ = stored(classes.join(several, "anchor"), "open-classes")
    samples = _samples(texts, key_filter(open_, "class_id"), length, anchor)
    samples = stored(samples.join(open_, "class_id").select("class_id", "anchor", "data", "n", "m"), "samples")
    groups = samples.count() // GROUP_CLASSES + 1
    dealt = samples.where(F.col("m") <= hot).withColumn("deal", F.pmod(F.xxhash64("anchor"), F.lit(groups)))
    near = dealt.select("class_id", "anchor", "data", "deal").groupBy("deal").applyInPandas(_compare(length), "class_id bigint, bits binary")
    partly = near.union(_compare_hot(samples.where(F.col("m") > hot), length))
    whole = classes.where("n > 1").select("class_id", F.lit(None).cast("binary").alias("bits"))
    return stored(whole.union(partly.join(whole.select("class_id"), "class_id", "left_anti")).dropDuplicates(["class_id"]), "windows")


def runs_of(found: list, length: int) -> list[int]:
    """Maximal covered runs, flat, of windows (first, last, bits); all windows where bits is null."""
    starts = []
    for first, last, bits in found:
        windows = np.arange(first, last + 1)
        if bits is not None:
            windows = windows[np.unpackbits(np.frombuffer(bits, np.uint8), count=len(windows)).astype(bool)]
        starts.append(windows)
    windows = np.unique(np.concatenate(starts)) if starts else np.empty(0, np.int64)
    if not len(windows):
        return []
    breaks = np.flatnonzero(np.diff(windows) > length)
    low = windows[np.concatenate([[0], breaks + 1])]
    high = windows[np.concatenate([breaks, [len(windows) - 1]])] + length
    return np.stack([low, high], axis=1).ravel().tolist()


def _covering(lists: DataFrame, length: int) -> DataFrame:
    def cover(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            runs = [runs_of([(f["first"], f["last"], f["bits"]) for f in found], length) for found in frame["found"]]
            yield pd.DataFrame({"text_key": frame["text_key"], "text_size": frame["text_size"], "runs": runs})

    return lists.mapInPandas(cover, "text_key bigint, text_size int, runs array<bigint>")


def kept_bytes(text: str, runs: list[int] | None) -> bytes:
    data, last, out = text.encode(), 0, []
    for start, end in zip(runs[::2], runs[1::2], strict=True) if runs else ():
        out.append(data[last:start])
        last = end
    return b"".join([*out, data[last:]])


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, batches: int = BATCHES, hot: int = HOT_CLASSES) -> DataFrame:
    """docs with `runs`, the maximal covered byte runs [start, end) flat and in order, and `kept`, the other bytes.

    A byte is covered if a string of `length` bytes around it starts at any other place of any text, the
    same text included; strings do not cross texts. A null text is empty. Texts shorter than
    `length` have no runs. Repeated rows cover each other. Existing columns named runs, kept, text_key
    or text_size are replaced; others stay. An empty table gives no rows.
    """
    windows = repeated_windows(docs, length, anchor, batches, hot)
    known = key_filter(windows, "class_id")

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in chunks(frames):
            found = []
            for key, size, text in zip(frame["text_key"], frame["text_size"], frame["text"], strict=True):
                for first, p in parts(text.encode(), length, anchor):
                    held = known.value.passes(p.classes)
                    if held.any():
                        low, high = first + p.low[held], first + p.high[held]
                        found.append(pd.DataFrame({"text_key": key, "text_size": size, "first": low, "last": high, "class_id": p.classes[held].view(np.int64)}))
            if found:
                yield pd.concat(found)

    keyed = docs.drop("runs", "kept").withColumns({"text_key": F.xxhash64("text"), "text_size": F.octet_length("text")})
    long_ = keyed.where(F.col("text_size") >= length).select("text_key", "text_size", "text")
    placed = long_.mapInPandas(place, "text_key bigint, text_size int, first bigint, last bigint, class_id bigint")
    lists = placed.join(windows, "class_id").groupBy("text_key", "text_size").agg(F.collect_set(F.struct("first", "last", "bits")).alias("found"))
    covered = stored(_covering(lists, length), "covered")
    listed = key_filter(covered, "text_key")
    marked = keyed.withColumn("maybe", passing(listed)("text_key"))
    untouched = marked.where("NOT maybe").drop("maybe").withColumns(
        {"runs": F.array().cast("array<bigint>"), "kept": F.coalesce("text", F.lit("")).cast("binary")}
    )
    met = marked.where("maybe").drop("maybe").join(covered, ["text_key", "text_size"], "left")
    met = met.withColumn("runs", F.coalesce("runs", F.array().cast("array<bigint>")))
    cut = appended(met, ["text", "runs"], lambda texts, runs: [list(map(kept_bytes, texts, runs))], "kept binary")
    return untouched.unionByName(cut).drop("text_key", "text_size")
