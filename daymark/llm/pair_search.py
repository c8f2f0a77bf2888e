"""Ranked search by MaxScore with bounds of term pairs.

The index is a table of posting lists by block of documents and term. For the terms of the queries
the lists get their impacts (the share of a score that one occurrence in the query brings), and for
pairs of neighbouring query terms the intersection of two lists is stored with its maximum joint
impact in the block, and the impact of its last document that could still be among the best.

At query time the terms of a block are sorted by their largest share. A prefix of them whose bound
lies below the score that the best documents are known to reach cannot lift a document on its own,
so candidates come from the other lists only. The bound of a prefix is smaller than the sum of the
terms' maxima: two terms of a stored pair add their joint maximum, or the larger one of the two where
no document holds both. A score that is certainly reached comes from the pairs, too: where k documents
of a block reach a joint impact, the k-th best score of the query is at least that.

Each step is one Spark job over blocks; a term in every document is split over all blocks.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymark.llm.shared import stored, tasks

#: A block ends at so many characters of text or documents, whatever comes first.
BLOCK_CHARS = 8 << 20
BLOCK_DOCS = 1 << 14
#: Query texts that are broadcast together, in bytes. Further ones follow in further passes over the index.
QUERY_BYTES = 8 << 20
#: Documents returned for each query.
TOP = 20

#: Lower-cases A-Z and turns what separates terms into spaces; bytes beyond ASCII stay.
_FOLD = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order: runs of letters, digits and whatever is not ASCII; none for null."""
    return (text or "").encode().translate(_FOLD).split()


INDEX = "block bigint, term string, df bigint, total bigint, places binary, counts binary"
_INDEX_ARROW = pa.schema(
    [("block", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("total", pa.int64()), ("places", pa.binary()), ("counts", pa.binary())]
)


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values that lie one behind the other: list i ends before entry ends[i]."""
    offsets = np.concatenate([[0], ends]) * values.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    )


class _Block:
    """Postings of the documents of one block while they are read."""

    def __init__(self):
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.terms, self.counts, self.held, self.chars = [], [], [], 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        found = Counter(terms_of(text))
        self.ids.append(doc_id)
        self.lengths.append(found.total())
        self.terms.append(np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found)))
        self.counts.append(np.fromiter(found.values(), np.int32, len(found)))
        self.held.append(len(found))
        self.chars += len(text or "")

    def full(self) -> bool:
        return self.chars >= BLOCK_CHARS or len(self.ids) >= BLOCK_DOCS

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        """First the row of the documents (an empty term: ids, lengths), then one row for each term."""
        lengths = np.array(self.lengths, np.int64)
        ids = pd.array(self.ids, "Int64")
        head = np.concatenate([ids.fillna(0).to_numpy(np.int64), np.asarray(ids.isna(), np.int64)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int64()),
                pa.array([""]),
                pa.array([int((lengths > 0).sum())], pa.int64()),
                pa.array([int(lengths.sum())], pa.int64()),
                pa.array([head.tobytes()], pa.binary()),
                pa.array([lengths.tobytes()], pa.binary()),
            ],
            schema=_INDEX_ARROW,
        )
        if not self.numbers:
            return
        terms, counts = np.concatenate(self.terms), np.concatenate(self.counts)
        places = np.repeat(np.arange(len(self.held), dtype=np.int32), self.held)
        order = np.argsort(terms, kind="stable")
        sizes = np.bincount(terms, minlength=len(self.numbers))
        ends = np.cumsum(sizes)
        totals = np.add.reduceat(counts[order].astype(np.int64), ends - sizes)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(sizes), block, np.int64)),
                pa.array(list(self.numbers), pa.binary()).cast(pa.string()),
                pa.array(sizes.astype(np.int64)),
                pa.array(totals),
                _lists(places[order], ends),
                _lists(counts[order], ends),
            ],
            schema=_INDEX_ARROW,
        )


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Posting lists of all documents, stored: one row for each block and term.

    places are the numbers of documents in their block, counts the occurrences there, both ascending by place
    as 32-bit integers. The row of a block with the empty term holds its documents: ids and a mark for
    null ids as places, numbers of terms as counts, how many have terms as df. Whole texts are read, a
    long one may make a block of its own.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            for doc_id, body in zip(batch.column(0), batch.column(1)):
                block.add(doc_id.as_py(), body.as_py())
                if block.full():
                    yield from block.rows(number)
                    number, block = number + 1, _Block()
        if block.ids:
            yield from block.rows(number)

    return stored(docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).mapInArrow(build, INDEX), "search-index")


class Query:
    """A query: its number, its terms with repeats, its pairs of neighbouring terms, each term's partners."""

    def __init__(self, number: int, text: str):
        found = [t.decode() for t in terms_of(text)]
        self.number, self.terms = number, Counter(found)
        self.pairs = {(min(a, b), max(a, b)) for a, b in zip(found, found[1:]) if a != b}
        self.partners: dict[str, set[str]] = {t: set() for t in self.terms}
        for a, b in self.pairs:
            self.partners[a].add(b)
            self.partners[b].add(a)


def query_blocks(queries: DataFrame, limit: int) -> Iterator[list[tuple[int, str]]]:
    """Queries as (number, text) in blocks of about `limit` bytes."""
    total = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // limit + 1
    for block in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).collect()
        yield [(r["number"], r["text"]) for r in rows]


COMPILED = "block bigint, first string, second string, best bigint, reached bigint, places binary, impacts binary"


def _impacts(counts: np.ndarray, lengths: np.ndarray, weight: int, n: int, total: int) -> np.ndarray:
    # Constants of the scoring rule.
    m = 75 + (25 * lengths * n) // total
    return weight * ((1_000_000_000 * counts) // (1000 * counts + 12 * m))


def _reached(values: np.ndarray, top: int) -> int:
    """The top-th largest value; 0 if there are fewer."""
    return int(np.partition(values, len(values) - top)[len(values) - top]) if len(values) >= top else 0


def compile_lists(index: DataFrame, queries: list[Query], top: int) -> DataFrame:
    """Lists with impacts of the queries' terms, intersection lists of their pairs, and the documents, by block; stored.

    best is the largest impact of a list, reached the top-th largest (0 if there are fewer documents).
    """
    spark = index.sparkSession
    facts = index.where("term = ''").agg(F.sum("df").alias("n"), F.sum("total").alias("total")).first()
    n, total = facts["n"] or 0, facts["total"] or 0
    wanted = spark.createDataFrame([(t,) for t in sorted({t for q in queries for t in q.terms})], "term string")
    lists = index.join(F.broadcast(wanted), "term", "left_semi")  # bounded by QUERY_BYTES
    df = lists.groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * n) + 2) / (2 * F.col("df") + 1).cast("double")))
    weights = spark.sparkContext.broadcast({r["term"]: r["w"] for r in df.select("term", weight.alias("w")).collect()})
    pairs = spark.sparkContext.broadcast(sorted({pair for q in queries for pair in q.pairs}))
    held = lists.unionByName(index.where("term = ''")).repartition(tasks(spark), "block")

    def compiled(rows: pd.DataFrame) -> pd.DataFrame:
        block, head = rows["block"].iat[0], rows[rows["term"] == ""].iloc[0]
        lengths = np.frombuffer(head["counts"], np.int64)
        out, found = [(block, "", "", 0, 0, head["places"], head["counts"])], {}
        for term, places, counts in zip(rows["term"], rows["places"], rows["counts"]):
            if term:
                places = np.frombuffer(places, np.int32)
                impacts = _impacts(np.frombuffer(counts, np.int32).astype(np.int64), lengths[places], weights.value[term], n, total)
                found[term] = places, impacts
                out.append((block, term, "", int(impacts.max()), _reached(impacts, top), places.tobytes(), impacts.tobytes()))
        for a, b in pairs.value:
            if a in found and b in found:
                both, i, j = np.intersect1d(found[a][0], found[b][0], assume_unique=True, return_indices=True)
                joint = found[a][1][i] + found[b][1][j]
                best = int(joint.max()) if len(joint) else 0
                out.append((block, a, b, best, _reached(joint, top), both.tobytes(), joint.tobytes()))
        return pd.DataFrame(out, columns=["block", "first", "second", "best", "reached", "places", "impacts"])

    return stored(held.groupBy("block").applyInPandas(compiled, COMPILED), "search-lists")


class BlockLists:
    """The compiled lists of one block."""

    def __init__(self, rows: pd.DataFrame):
        self.lists, self.joint = {}, {}
        self.ids = self.none = np.empty(0, np.int64)
        for first, second, best, places, impacts in rows[["first", "second", "best", "places", "impacts"]].itertuples(index=False):
            if not first:
                self.ids, self.none = np.split(np.frombuffer(places, np.int64), 2)
            elif not second:
                self.lists[first] = np.frombuffer(places, np.int32), np.frombuffer(impacts, np.int64), best
            else:
                self.joint[first, second] = best
        self.scores = np.zeros(len(self.ids), np.int64)

    def bounds(self, terms: list[tuple[str, int]], query: Query) -> list[int]:
        """Bound of the score that the first i terms can add together, for every i. Terms are paired greedily."""
        out, single = [0], {}
        for term, times in terms:
            most = times * self.lists[term][2]
            saved, partner = 0, None
            for other in sorted(query.partners[term] & single.keys()):
                others, rest = single[other]
                joint = self.joint[min(term, other), max(term, other)]
                both = min(times, others)
                together = both * joint + (times - both) * self.lists[term][2] + (others - both) * self.lists[other][2]
                gain = most + rest - max(most, rest, together if joint else 0)
                if gain > saved:
                    saved, partner = gain, other
            if partner is None:
                single[term] = times, most
            else:
                del single[partner]
            out.append(out[-1] + most - saved)
        return out

    def best(self, query: Query, known: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the block's best documents, none that is certainly below `known`."""
        terms = sorted(((t, m) for t, m in query.terms.items() if t in self.lists), key=lambda x: (x[1] * self.lists[x[0]][2], x[0]))
        bounds = self.bounds(terms, query)
        floor = max(known, 1)
        skipped = len(terms)
        while bounds[skipped] >= floor:
            skipped -= 1
        if skipped == len(terms):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        scores = self.scores
        touched = []
        for term, times in terms[skipped:]:
            places, impacts, _ = self.lists[term]
            scores[places] += times * impacts
            touched.append(places)
        every = np.unique(np.concatenate(touched))
        places = every
        for i in range(skipped, -1, -1):
            # What the first i terms can still add decides who stays.
            places = places[scores[places] + bounds[i] >= floor]
            if not i or not len(places):
                break
            own, impacts, _ = self.lists[terms[i - 1][0]]
            at = np.minimum(np.searchsorted(own, places), len(own) - 1)
            scores[places] += np.where(own[at] == places, terms[i - 1][1] * impacts[at], 0)
        found = scores[places]
        order = np.lexsort((self.ids[places], self.none[places], -found))[:top]
        places, found = places[order], found[order]
        scores[every] = 0
        return places, found


FOUND = "number bigint, id bigint, score bigint"


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, query_id: str = "item_id", key: str = "doc_id", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """For each query the `top` documents of highest score above 0: query_id, rank from 1, doc_id, score.

    Terms, weights and scores are those of the module's rule; a term that a query repeats counts as often.
    Equal scores go by ascending id, null ids last. Null and empty texts have no terms: such documents are
    not found and such queries find nothing, as do empty tables. Repeated documents are found each; a
    repeated query (id and text) is answered once. Other columns of both tables are left out.
    """
    spark = docs.sparkSession
    index = build_index(docs, key)
    asked = queries.select(F.col(query_id), F.col("text")).distinct()
    asked = stored(asked.withColumn("number", F.monotonically_increasing_id()), "search-queries")
    found = []
    for rows in query_blocks(asked.where("text IS NOT NULL"), query_bytes):
        part = [Query(number, text) for number, text in rows]
        lists = compile_lists(index, part, top)
        found.append(_answers(lists, part, top))
    answers = found[0]
    for more in found[1:]:
        answers = answers.unionByName(more)
    best = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = answers.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(asked, "number").select(query_id, "rank", F.col("id").alias(key), "score")


def _answers(lists: DataFrame, queries: list[Query], top: int) -> DataFrame:
    context = lists.sparkSession.sparkContext
    # A score that some block's lists prove for each term and pair; one number for each, bounded by QUERY_BYTES.
    proven = lists.where("first <> ''").groupBy("first", "second").agg(F.max("reached").alias("reached"))
    known = {(r["first"], r["second"]): r["reached"] for r in proven.where("reached > 0").collect()}
    floors = {
        q.number: max(
            0,
            *(times * known.get((t, ""), 0) for t, times in q.terms.items()),
            *(min(q.terms[a], q.terms[b]) * known.get((a, b), 0) for a, b in q.pairs),
        )
        for q in queries
        if q.terms
    }
    shared = context.broadcast([(q, floors[q.number]) for q in queries if q.terms])

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        block, out = BlockLists(rows), []
        for query, floor in shared.value:
            places, scores = block.best(query, floor, top)
            ids = pd.array(block.ids[places], "Int64")
            ids[block.none[places] == 1] = pd.NA
            out.append(pd.DataFrame({"number": np.full(len(places), query.number), "id": ids, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"number": [], "id": [], "score": []})

    return lists.repartition(tasks(lists.sparkSession), "block").groupBy("block").applyInPandas(answer, FOUND)
