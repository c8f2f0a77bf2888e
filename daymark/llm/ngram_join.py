"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

A document's row of the incidence matrix is its set of hashed 5-word shingles. Equal sets form one
class and are joined once. Pairs with a similarity of at least t share a shingle among the
n - ceil(t n) + 1 first ones of both sets, in any common order, so only these columns are
multiplied. The order puts rare shingles first, by a sketch of fixed size that counts all shingles:
passages that very many documents hold come last and make no pairs.

A column of the product with m documents would give m * m / 2 pairs. Instead, rounds of stars run: each
column pairs one pivot with its other documents, pairs whose sizes rule them out are discarded, the
others' overlaps are counted on the whole sets, and what is linked becomes one component. Inside a
component nothing is left to find, so columns of near copies shrink to nothing. The pivot is the
document with the fewest rare shingles, for copies the text nearest to what they share. Columns that
still hold several components are multiplied in full at last, across components only, and of their pairs
those go at once whose parities in hashed buckets differ in more places than similar sets can. No link
between components is lost.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.components import components
from daymark.llm.shared import batch_hashes, bounded_batches, chunks, key_filter, passing, rolled, stored, word_bytes

GRAM = 5
PERCENT = 80
#: Counters of the sketch (16 MB) and the slices in which they travel.
COUNTERS, SLICES = 1 << 21, 16
#: Stars go on while the columns hold more pairs than this for each row and shrink.
PAIRS_PER_ROW = 8
#: Texts in characters that are hashed together.
_TOGETHER = 1 << 20
#: A column's code has its level above these bits of the shingle's hash, a row's label the share of rare
#: shingles above these bits of the set's hash (its class id).
_BITS = 58


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Ascending distinct hashes of each text's 5-word shingles; of fewer words, of the whole sequence; none without words."""
    words = batch_hashes([t.encode("utf-8", "replace").lower() for t in texts], word_bytes())
    every = rolled(np.concatenate(words), GRAM) if words else words
    out, start = [], 0
    for h in words:
        grams = every[start : start + len(h) - GRAM + 1] if len(h) >= GRAM else rolled(h, len(h)) if len(h) else h
        start += len(h)
        grams = np.sort(grams)
        out.append(grams[np.concatenate([[True], grams[1:] != grams[:-1]])] if len(grams) else grams)
    return out


def class_of(grams: np.ndarray) -> int:
    """The same number for equal sets."""
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little") >> (64 - _BITS)


def _counter(grams: np.ndarray) -> np.ndarray:
    return (grams & np.uint64(COUNTERS - 1)).view(np.int64)


def _least_common(n: int) -> int:
    return -(-PERCENT * n // 100)


_MEASURED = ["doc_id", "row_key", "class_id", "n", "marks", "slice", "counts"]
#: Bits of a set's marks, in words of 64.
MARKS, _WORDS = 512, 8


def _marks(grams: np.ndarray) -> list[int]:
    """For each of MARKS buckets whether it holds an odd number of shingles.

    Each shingle that only one of two sets holds turns one bit, so the bits in which their marks differ
    are no more than the shingles in which the sets do.
    """
    odd = np.bincount((grams >> np.uint64(40)).view(np.int64) & (MARKS - 1), minlength=MARKS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64).tolist()


def _row_key() -> Column:
    """The same number for rows of one id and one text."""
    return F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id").cast("bigint"), F.col("text").isNull(), "text")


def _measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Class and size of each document, then the task's counters in slices."""
    counters = np.zeros(COUNTERS, np.int64)
    for frame in chunks(frames, limit=_TOGETHER):
        sets = shingle_sets(frame["text"].tolist())
        every = np.concatenate(sets)
        if len(every) > COUNTERS // 32:
            counters += np.bincount(_counter(every), minlength=COUNTERS)
        else:
            np.add.at(counters, _counter(every), 1)
        rows = [(key, row, class_of(g), len(g), _marks(g), None, None) for key, row, g in zip(frame["doc_id"], frame["row_key"], sets, strict=True)]
        yield pd.DataFrame(rows, columns=_MEASURED)
    cut = [(None, None, None, None, None, i, zlib.compress(part.tobytes(), 1)) for i, part in enumerate(np.split(counters, SLICES)) if part.any()]
    if cut:
        yield pd.DataFrame(cut, columns=_MEASURED)


def _summed(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(COUNTERS // SLICES, np.int64)
    for part in frame["counts"]:
        total += np.frombuffer(zlib.decompress(part), np.int64)
    return pd.DataFrame({"slice": frame["slice"][:1], "counts": [zlib.compress(total.tobytes(), 1)]})


def frequency_levels(measured: DataFrame) -> np.ndarray:
    """How far each counter lies above the mean, in powers of two of four deviations of it.

    At most 16 MB come to the driver, whatever the input: counters are summed in two steps, so no task
    takes a slice from all tasks at once.
    """
    kinds = "slice bigint, counts binary"
    counted = measured.where("slice IS NOT NULL").select("slice", "counts", F.pmod(F.xxhash64("counts"), F.lit(8)).alias("part"))
    partly = counted.groupBy("slice", "part").applyInPandas(lambda frame: _summed(frame), kinds)
    total, size = np.zeros(COUNTERS, np.int64), COUNTERS // SLICES
    for row in partly.groupBy("slice").applyInPandas(_summed, kinds).toLocalIterator():
        total[row["slice"] * size : (row["slice"] + 1) * size] = np.frombuffer(zlib.decompress(bytes(row["counts"])), np.int64)
    above = np.maximum(total - total.mean(), 0) / (4 * np.sqrt(1 + total.mean()))
    return np.minimum(np.log2(1 + above), 31).astype(np.uint8)


def _leading(levels):
    """The first columns of each set's row: (code, label, place, n). Copies in one task come once.

    Labels order rows by the share of their rare shingles.
    """

    def lead(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        level, seen = levels.value, set()
        for frame in chunks(frames, limit=_TOGETHER):
            codes, labels, sizes, counts = [], [], [], []
            for grams in shingle_sets(frame["text"].tolist()):
                n, key = len(grams), class_of(grams)
                if not n or key in seen:
                    continue
                seen.add(key)
                own = level[_counter(grams)]
                row = (own.astype(np.uint64) << np.uint64(_BITS)) | (grams >> np.uint64(64 - _BITS))
                row.sort()
                codes.append(row[: n - _least_common(n) + 1])
                labels.append(int(31 * np.count_nonzero(own == 0) / n) << _BITS | key)
                sizes.append(len(codes[-1]))
                counts.append(n)
            if len(seen) > 500_000:
                seen.clear()
            if codes:
                yield pd.DataFrame(
                    {
                        "code": np.concatenate(codes).view(np.int64),
                        "label": np.repeat(np.array(labels, np.int64), sizes),
                        "place": np.concatenate([np.arange(s) for s in sizes]),
                        "n": np.repeat(counts, sizes),
                    }
                )

    return lead


def _sets(wanted):
    """(class_id, grams) of the classes that pass the filter; copies in one task come once."""

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for frame in chunks(frames, limit=_TOGETHER):
            sets = shingle_sets(frame["text"].tolist())
            keys = np.array([class_of(g) for g in sets], np.int64)
            passed = wanted.value.passes(keys.view(np.uint64))
            rows = {int(k): g.view(np.int64) for k, g, p in zip(keys, sets, passed, strict=True) if p and int(k) not in seen}
            seen.update(rows)
            if len(seen) > 500_000:
                seen.clear()
            if rows:
                yield pd.DataFrame({"class_id": list(rows), "grams": list(rows.values())})

    return keep


def _class_id(label: str) -> Column:
    return F.col(label).bitwiseAND((1 << _BITS) - 1)


def _first_common(n_a: str, place_a: str, n_b: str, place_b: str) -> Column:
    """Can this column be the first common one of two similar sets?

    Before its first common column a set holds at most its size less the overlap that the two need. A
    similar pair meets at its first common column, so others need not be paired there.
    """
    needed = (F.col(n_a) + F.col(n_b)) * PERCENT
    fits = lambda n, place: (F.col(n) - F.col(place)) * (100 + PERCENT) >= needed
    return fits(n_a, place_a) & fits(n_b, place_b)


def _possible(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs (a, b) of labels that the overlap of their leading columns leaves possible.

    What follows the leading columns of both can add at most the longer rest to the overlap.
    """
    close = stored(pairs, "close")
    ids = close.select(F.explode(F.array("a", "b")).alias("label")).distinct()
    rows = stored(members.join(ids, "label", "left_semi").groupBy("label").agg(F.collect_set("code").alias("codes")), "codes")
    both = close.join(rows.toDF("a", "codes_a"), "a").join(rows.toDF("b", "codes_b"), "b")
    common = F.size(F.array_intersect("codes_a", "codes_b"))
    rest = F.floor((F.greatest("n_a", "n_b") * PERCENT + 99) / 100) - 1
    return both.where((common + rest) * (100 + PERCENT) >= (F.col("n_a") + F.col("n_b")) * PERCENT).select("a", "b")


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of labels whose whole sets, read from the texts, are similar enough."""
    sides = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("side")).withColumn("class_id", _class_id("side"))
    ids = stored(sides.select("class_id").distinct(), "wanted")
    if ids.isEmpty():
        return pairs.limit(0)
    sets = texts.mapInPandas(_sets(key_filter(ids, "class_id")), "class_id bigint, grams array<bigint>")
    one = sets.join(ids, "class_id").groupBy("class_id").agg(F.first("grams").alias("grams"))
    met = sides.join(one, "class_id").groupBy("a", "b").agg(F.collect_list("grams").alias("both"))
    x, y = F.col("both")[0], F.col("both")[1]
    common = F.size(F.array_intersect(x, y))
    return met.where(100 * common >= PERCENT * (F.size(x) + F.size(y) - common)).select("a", "b")


def _product(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """All pairs of the columns, across components, that their sets' marks leave possible."""
    marked = stored(rows.withColumn("class_id", _class_id("label")).join(marks, "class_id").drop("class_id"), "marked")
    a = marked.toDF("code", "a", "place_a", "n_a", "root_a", "marks_a")
    b = marked.toDF("code", "b", "place_b", "n_b", "root_b", "marks_b")
    differ = sum((F.bit_count(F.col("marks_a")[i].bitwiseXOR(F.col("marks_b")[i])) for i in range(_WORDS)), F.lit(0))
    # Similar sets differ in (100 - PERCENT) of (100 + PERCENT) parts of both sizes together at most.
    close = differ * (100 + PERCENT) <= (F.col("n_a") + F.col("n_b")) * (100 - PERCENT)
    met = a.join(b, "code").where("a < b AND root_a <> root_b").where(_first_common("n_a", "place_a", "n_b", "place_b") & close)
    return met.select("a", "b", "n_a", "n_b").distinct()


def _settled(pairs: DataFrame, links, roots, rows: DataFrame, members: DataFrame, texts: DataFrame):
    """Links, roots and rows after the pairs are judged."""
    possible = stored(_possible(pairs, members), "possible")
    found = stored(_linked(possible, texts), "links")
    links = found if links is None else links.union(found)
    roots = stored(components(links), "roots")
    moved = rows.drop("root").join(roots.withColumnRenamed("node", "label"), "label", "left")
    return links, roots, stored(moved.select("code", "label", "place", "n", F.coalesce("root", "label").alias("root")), "rows")


def join_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row_key, class_id, n) of each document; (node, root) of each class that is linked with another."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select("text")
    kinds = "doc_id string, row_key bigint, class_id bigint, n bigint, marks array<bigint>, slice bigint, counts binary"
    measured = stored(docs.select(F.col("doc_id").cast("string"), _row_key().alias("row_key"), "text").mapInPandas(_measure, kinds), "measured")
    named = measured.where("slice IS NULL").select(F.col("doc_id").cast("bigint"), "row_key", "class_id", "n")
    levels = spark.sparkContext.broadcast(frequency_levels(measured))
    leading = texts.mapInPandas(_leading(levels), "code bigint, label bigint, place int, n int")
    several = leading.groupBy("code").agg(F.min("label").alias("pivot"), F.max("label").alias("high")).where("pivot <> high")
    first = stored(leading.join(several.select("code", "pivot"), "code").distinct(), "columns")
    members = first.select("code", "label")
    pivots = first.where("label = pivot").select("code", F.col("place").alias("pivot_place"), F.col("n").alias("pivot_n"))
    stars = first.join(pivots, "code").withColumns({"root": F.col("label"), "pivot_root": F.col("pivot")})
    links, roots, before = None, None, None
    while True:
        met = stars.where("root <> pivot_root").where(_first_common("n", "place", "pivot_n", "pivot_place"))
        pairs = met.select(F.col("pivot").alias("a"), F.col("label").alias("b"), F.col("pivot_n").alias("n_a"), F.col("n").alias("n_b")).distinct()
        # Pivots have met all rows of their columns.
        rows = stars.where("label <> pivot").select("code", "label", "place", "n", "root")
        links, roots, rows = _settled(pairs, links, roots, rows, members, texts)
        columns = rows.groupBy("code").agg(
            F.count("*").cast("double").alias("m"),
            F.min("label").alias("pivot"),
            F.min_by("root", "label").alias("pivot_root"),
            F.min_by("place", "label").alias("pivot_place"),
            F.min_by("n", "label").alias("pivot_n"),
            F.min("root").alias("low"),
            F.max("root").alias("high"),
        )
        columns = stored(columns.where("low <> high").drop("low", "high"), "open")
        size = columns.agg(F.sum("m"), F.sum(F.col("m") * F.col("m"))).first()
        if not size[0]:
            break
        rows = stored(rows.join(columns, "code"), "open-rows")
        if size[1] <= PAIRS_PER_ROW * size[0] or (before is not None and size[1] > 0.7 * before):
            rows = rows.select("code", "label", "place", "n", "root")
            marks = measured.where("n > 0").select("class_id", "marks").dropDuplicates(["class_id"])
            links, roots, _ = _settled(_product(rows, marks), links, roots, rows, members, texts)
            break
        before, stars = size[1], rows.drop("m")
    return named, roots.select(_class_id("node").alias("node"), _class_id("root").alias("root"))


def near_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of docs (doc_id, text).

    component_id is the smallest doc_id that links lead to from the document, itself included; two
    documents link when 100 * intersection >= 80 * union of their sets. A document without text or
    words has an empty set, no links and its own id. Equal sets link, so repeated rows share a
    component. Null ids count as no id: a component of these only has none. An empty table gives
    no rows; other columns are ignored, whatever their names.
    """
    rows, roots = join_classes(docs)
    classes = rows.where("n > 0").groupBy("class_id").agg(F.min("doc_id").alias("least"))
    rooted = classes.join(roots.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "class_id", "least", F.coalesce("root", "class_id").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(rooted.join(least, "root").select("class_id", "component_id"), "named")
    full = rows.where("n > 0").join(named, "class_id", "left").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.union(rows.where("n = 0").select("doc_id", "n", "doc_id"))


def keep_representatives(docs: DataFrame) -> DataFrame:
    """docs with one row of each component: the one with the smallest doc_id, without an id only if none has one.

    Texts decide, not ids: of different texts with one id, each stays or goes with its own component. Of texts
    with the same smallest id in a component the one with the smallest hash stays, of repeated rows one.
    Documents without words or without links stay. Columns stay as they are.
    """
    rows, roots = join_classes(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    classes = rows.where("n > 0").groupBy("class_id").agg(F.min(order).alias("least"))
    rooted = classes.join(roots.withColumnRenamed("node", "class_id"), "class_id", "left").withColumn("root", F.coalesce("root", "class_id"))
    least = rooted.groupBy("root").agg(F.min("least").alias("first"))
    named = stored(rooted.join(least, "root").select("class_id", F.col("first.row_key").alias("kept_key")), "kept")
    full = rows.where("n > 0").join(named, "class_id").select("row_key", (F.col("row_key") != F.col("kept_key")).alias("goes"))
    bare = rows.where("n = 0 AND doc_id IS NOT NULL").select("row_key", F.lit(False))
    keys = full.union(bare).groupBy("row_key").agg(F.max("goes").alias("goes"), F.count("*").alias("m"))
    touched = stored(keys.where("goes OR m > 1").select(F.col("row_key").alias("_row_key"), F.col("goes").alias("_goes")), "touched")
    keyed = docs.withColumn("_row_key", _row_key())
    maybe = keyed.withColumn("_maybe", passing(key_filter(touched, "_row_key"))("_row_key"))
    plain = maybe.where("NOT _maybe").select(*docs.columns)
    met = maybe.where("_maybe").join(touched, "_row_key", "left")
    unknown = met.where("_goes IS NULL").select(*docs.columns)
    one = met.where("NOT _goes").dropDuplicates(["_row_key"])
    return plain.unionByName(unknown).unionByName(one.select(*docs.columns))
