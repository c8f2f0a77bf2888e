"""Packing: first-fit decreasing with a tournament tree, run in randomised groups of documents.

A first pass tokenizes the texts and keeps only lengths and checksums: each document becomes as many
full pieces as fit and one shorter rest. Pieces are dealt to groups by a hash, and each group is
packed on its own. A bin of a group is found in logarithmic time as the leftmost leaf of a tree
that holds, at each node, the largest free space below it. Text never leaves the first pass.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.shared import Generations, chunks

#: The document end, after each document's ids.
END_ID = 2
#: Documents in a group: enough for close packing, small enough for one task.
GROUP_DOCUMENTS = 4096

#: Ids travel as text: pandas would turn whole numbers beside nulls into floating ones.
PIECES = "doc_id string, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: printable ones as they are."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


#: Marks that begin no token together with letters before them.
_MARKS = ".,;:!?$%&*#|()"


class WordTokenizer(Generations):
    """Packed ids of space-separated words: a cache for tokenizers that lower-case letters and drop white space.

    Such a tokenizer forms no token across a space or a line feed, so the ids of a text are those of
    its words in order. Texts of Latin-1 letters are put in lower case as a whole, unless a special string
    may be in them. Words of such letters go straight to the tokenizer's model, marks that end
    them form tokens of their own, and everything else (other letters, digits, other marks and white
    space, special strings) goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__(self._ids, limit=150_000)
        self.tokenizer, self.letters = Tokenizer.from_file(path), _byte_letters()
        self.model = self.tokenizer.model
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: A letter that all special strings hold, if there is one.
        self.mark = "<" if all("<" in t for t in special) else None

    def _ids(self, word: str) -> bytes:
        if word.isalpha() and word.isascii():
            low = word.lower()
            return self[low] if low != word else self._packed([x.id for x in self.model.tokenize(word)])
        stem = word.rstrip(_MARKS)
        if stem and stem != word and stem.isalpha() and max(stem) <= "\xff":
            return self[stem] + self[word[len(stem) :]]
        if stem == word and word.isalpha() and max(word) <= "\xff":
            low = word.lower()
            if low != word:
                return self[low]
            seen = word.encode().decode("latin-1").translate(self.letters)
            return self._packed([x.id for x in self.model.tokenize(seen)])
        return self._packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _lowered(self, text: str) -> str:
        """The text in lower case, where that changes none of its ids."""
        if self.mark is None or self.mark in text:
            return text
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text.lower()

    def encode(self, text: str) -> bytes:
        """Unsigned little-endian 32-bit ids of a whole text."""
        text = self._lowered(text)
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One cache for each Python worker."""
    return WordTokenizer(path)


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in it) of each item, in the order given; bins are numbered from 0."""
    order = np.argsort(-sizes, kind="stable")
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    free = [capacity] * (2 * leaves)  # free[n]: largest free space in the leaves below node n
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i in order.tolist():
        size, node = int(sizes[i]), 1
        while node < leaves:
            node *= 2
            if free[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - free[node]
        free[node] -= size
        node //= 2
        while node:
            best = free[2 * node] if free[2 * node] >= free[2 * node + 1] else free[2 * node + 1]
            if free[node] == best:
                break
            free[node] = best
            node //= 2
    return bins, offsets


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document in full pieces and a rest.

    A null text counts as empty: its one id is the document end. The file of the tokenizer must be at
    the same path on every executor.
    """

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = word_tokenizer(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        for frame in chunks(frames):
            rows = []
            for key, body in zip(frame["doc_id"], frame["text"], strict=True):
                ids = words.encode(body) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    rows.append((key, start, len(piece) // 4, zlib.crc32(piece), total))
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(doc).cast("string").alias("doc_id"), F.col(text).alias("text")).mapInPandas(cut, PIECES)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, seed: int = 7, group_documents: int = GROUP_DOCUMENTS) -> DataFrame:
    """Where each piece of each document lies: the columns of `token_pieces` with sequence_id and offset.

    docs needs doc_id and text; other columns are ignored, whatever their names. Sequences hold at most
    `capacity` ids, and their pieces follow each other without gaps from offset 0. Documents are
    cut only where they are longer than a sequence. Null ids, repeated rows and equal texts are
    packed like others. No documents give no rows. Groups are drawn by a hash of what the piece
    holds, so a repeated run gives the same packing.
    """
    groups = max(1, -(-docs.count() // group_documents))
    pieces = token_pieces(docs, tokenizer, capacity)
    draw = F.xxhash64("doc_id", "start", "ids_crc32", F.spark_partition_id(), F.lit(seed))
    dealt = pieces.withColumn("group_id", F.pmod(draw, F.lit(groups)))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        bins, offsets = first_fit_decreasing(frame["length"].to_numpy(), capacity)
        return frame.assign(sequence_id=frame["group_id"] * (1 << 32) + bins, offset=offsets).drop(columns="group_id")

    packed = dealt.groupBy("group_id").applyInPandas(pack, PIECES + ", sequence_id bigint, offset bigint")
    return packed.withColumn("doc_id", F.col("doc_id").cast("bigint"))
