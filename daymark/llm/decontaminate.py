"""Benchmark decontamination by winnowing.

Both sides are cut into words, and every run of k = 5 words is hashed. Of each window of w = 6
neighbouring hashes the smallest is kept (the last one among equals), so any 10 words that two
texts share leave the same fingerprint at the same place in both. The documents' fingerprints are
joined with the benchmark's, and each hit is extended: all runs of 10 words around it are looked up
among the benchmark's runs. Items of fewer than 10 words are one run each, and each of
their lengths has a fingerprint at every place (w = 1).

The benchmark is dealt into blocks of a bounded size. One block at a time is broadcast and joined
with all documents; almost always there is one. Documents are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.shared import appended, batch_hashes, byte_set, rolled, stored

RUN = 10
GRAM = 5
#: Bytes of benchmark text in a block; its arrays in a worker take about ten times as much.
BLOCK_BYTES = 8 << 20

#: Bytes of words: digits and letters (A-Z lower-cased) and all of UTF-8 beyond ASCII; others separate.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


_SEPARATORS = byte_set(b" ")


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """Hashes of each text's words, in order."""
    return batch_hashes([t.encode("utf-8", "replace").translate(_LETTERS) for t in texts], _SEPARATORS)


def winnowed(grams: np.ndarray, window: int) -> np.ndarray:
    """Ascending places of the smallest hash of each full window, the last among equals."""
    n = len(grams) - window + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, place = grams[:n].copy(), np.arange(n)
    for i in range(1, window):
        lower = grams[i : i + n] <= best
        best[lower] = grams[i : i + n][lower]
        place[lower] = np.flatnonzero(lower) + i
    return np.unique(place)


class Benchmark:
    """Runs and fingerprints of a block of benchmark items, as sorted arrays."""

    def __init__(self, items: list[tuple[str, str]]):
        self.ids: list[str] = []
        prints, runs, owners = [], {}, {}
        for (item, _), h in zip(items, word_hashes([t for _, t in items]), strict=True):
            if not len(h):
                continue
            number, n = len(self.ids), min(RUN, len(h))
            self.ids.append(item)
            found = rolled(h, n)
            runs.setdefault(n, []).append(found)
            owners.setdefault(n, []).append(np.full(len(found), number))
            if n == RUN:
                grams = rolled(h, GRAM)
                prints.append(grams[winnowed(grams, RUN - GRAM + 1)])
        self.prints = np.unique(np.concatenate(prints)) if prints else np.empty(0, np.uint64)
        self.runs = {}
        for n, parts in runs.items():
            key, owner = np.concatenate(parts), np.concatenate(owners[n])
            order = np.argsort(key, kind="stable")
            self.runs[n] = (key[order], owner[order])

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, set[str]]:
        """(which words lie in a run of an item, the items with such runs) for a document's word hashes."""
        edges, items = np.zeros(len(h) + 1, np.int64), set()
        for n, (key, owner) in self.runs.items():
            if len(h) < n:
                continue
            grams = rolled(h, min(n, GRAM) if n == RUN else n)
            if n == RUN:
                places = winnowed(grams, RUN - GRAM + 1)
                places = places[within(grams[places], self.prints)]
                # Extension: every run around a hit.
                starts = np.unique((places[:, None] - np.arange(RUN - GRAM + 1)).ravel())
                starts = starts[(starts >= 0) & (starts <= len(h) - n)]
                found = np.array([rolled(h[a : a + n], n)[0] for a in starts.tolist()], np.uint64)
            else:
                starts, found = np.arange(len(grams)), grams
            held = within(found, key)
            starts, found = starts[held], np.unique(found[held])
            np.add.at(edges, starts, 1)
            np.add.at(edges, starts + n, -1)
            for a, b in zip(np.searchsorted(key, found, "left"), np.searchsorted(key, found, "right"), strict=True):
                items.update(self.ids[i] for i in np.unique(owner[a:b]))
        return np.cumsum(edges[:-1]) > 0, items


def within(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values lie in a sorted array."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """Items as (id, text) in blocks of about `block_bytes`; null texts have no words, a null id is empty."""
    items = benchmark.where("text IS NOT NULL").select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // block_bytes + 1
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        yield [(r["item"], r["text"]) for r in rows]


RESULT = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"
#: What a block hands to the next one.
_STATE = "hit_mask binary, hit_items array<string>"


def find_contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with n_words, n_hit, n_items, items_sha256 and contaminated, from its column text.

    n_hit counts the words inside any run of an item, n_items the items with such runs, and
    items_sha256 is the digest of their ids, sorted as strings and joined by commas (of the empty
    string if there are none). contaminated: n_hit is above 0. Null and empty texts have no words. An
    empty benchmark leaves every document clean; an empty docs table gives no rows. Repeated rows
    are judged each; a repeated item counts once. Columns with the new names are replaced, others stay.
    """
    context = docs.sparkSession.sparkContext
    state = docs.drop("hit_mask", "hit_items")
    blocks = benchmark_blocks(benchmark, block_bytes)
    block, seen = next(blocks), ["text"]
    while block is not None:
        following = next(blocks, None)
        state = appended(state, seen, _joined(context.broadcast(Benchmark(block)), following is None), RESULT if following is None else _STATE)
        if following is not None:
            state, seen = stored(state, "decontaminate"), ["text", "hit_mask", "hit_items"]
        block = following
    return state.drop("hit_mask", "hit_items")


def _joined(shared, last: bool):
    def join(texts: list[str], masks: list | None = None, items: list | None = None) -> list:
        rows, known = [], shared.value
        for i, h in enumerate(word_hashes(texts)):
            hit, found = known.hits(h)
            if masks is not None:
                hit |= np.unpackbits(np.frombuffer(masks[i], np.uint8), count=len(h)).astype(bool)
                found |= set(items[i])
            if last:
                listed, n = ",".join(sorted(found)), int(hit.sum())
                rows.append((len(h), n, len(found), hashlib.sha256(listed.encode()).hexdigest(), n > 0))
            else:
                rows.append((np.packbits(hit).tobytes(), sorted(found)))
        return list(zip(*rows, strict=True))

    return join
