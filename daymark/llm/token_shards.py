"""Token-ID output: every sequence at its place in training order, in binary shards.

One pass tokenizes the documents. The ids of a partition's documents follow each other, each document closed
by an end id, and are cut into sequences of a fixed stride; the partition's last one is padded.
A sequence's number is its place in its partition after the numbers reserved for the partitions before (as
many as their bytes could give ids). A keyed Feistel network, walked until it falls inside the range,
permutes these numbers: the result is the sequence's global slot. Shards are equal ranges of slots, so
one shuffle by range brings each shard's sequences together, and one task writes them in order.

A shard file holds: 8 letters of mark, stride and count (4 bytes each), the slots (8 bytes each), then
count x stride ids of 2 bytes, all little-endian. A reader that has read n sequences goes on at a known
byte. Shards appear under their names only when complete, and a task that runs again writes the same.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.packing import word_tokenizer
from daymark.llm.shared import chunks, folder, mixed, stored

MARK = b"DMSHARD1"
STRIDE = 2048
PAD_ID = 0
#: The tokenizer's own id for the end of a text, which no text without that string holds.
END_ID = 49407
#: Sequences that a shard has room for, on average: 16 MB of ids.
SHARD_SEQUENCES = 4096
ROUNDS = 4


def _half_bits(size: int) -> int:
    """Half the bits of the smallest even-sized domain of powers of two that holds `size` numbers."""
    return max(1, ((size - 1).bit_length() + 1) // 2)


def _keys(key: int) -> list[np.uint64]:
    return [mixed(np.array([key + i], np.uint64))[0] for i in range(1, ROUNDS + 1)]


def _network(x: np.ndarray, bits: int, keys: list[np.uint64], back: bool) -> np.ndarray:
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    left, right = x >> shift, x & mask
    for k in reversed(keys) if back else keys:
        if back:
            left, right = right ^ (mixed(left ^ k) & mask), left
        else:
            left, right = right, left ^ (mixed(right ^ k) & mask)
    return (left << shift) | right


def permuted(numbers: np.ndarray, size: int, key: int, back: bool = False) -> np.ndarray:
    """Keyed permutation of 0 .. size - 1 (or its inverse): walked along the network's cycle back into the range."""
    bits, keys = _half_bits(size), _keys(key)
    out = _network(numbers.astype(np.uint64), bits, keys, back)
    while (outside := out >= np.uint64(size)).any():
        out[outside] = _network(out[outside], bits, keys, back)
    return out


def shard_bytes(slots: np.ndarray, ids: list[bytes], stride: int) -> bytes:
    head = MARK + np.array([stride, len(ids)], "<u4").tobytes()
    return b"".join([head, slots.astype("<u8").tobytes(), *ids])


def read_shard(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(slots, ids by sequence) of a shard file."""
    if content[:8] != MARK:
        raise ValueError("not a shard")
    stride, count = np.frombuffer(content, "<u4", 2, 8)
    slots = np.frombuffer(content, "<u8", count, 16)
    return slots, np.frombuffer(content, "<u2", int(count) * int(stride), 16 + 8 * int(count)).reshape(int(count), int(stride))


def _reserved(docs: DataFrame, stride: int) -> dict[int, tuple[int, int]]:
    """(first number, numbers) of each partition. An id takes at least a byte, so bytes bound ids."""
    n = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1)
    rows = docs.groupBy(F.spark_partition_id().alias("part")).agg(n.alias("n")).orderBy("part").collect()
    first, out = 0, {}
    for row in rows:
        room = -(-row["n"] // stride)
        out[row["part"]] = (first, room)
        first += room
    return out


def write_shards(docs: DataFrame, tokenizer: str, path: str | None = None, stride: int = STRIDE, key: int = 1, shard_sequences: int = SHARD_SEQUENCES) -> tuple[str, DataFrame]:
    """Write all texts of docs (text) as shards below `path`; gives the path and the manifest.

    The manifest has a row for each shard: shard, file, sequences, ids (without padding), crc32 of the
    file, first_slot and last_slot. Null and empty texts are one end id each. Repeated rows are written
    each. No documents give no shards. Other columns are ignored. The same table in the same
    partitions gives the same shards. Token ids have to be below 65,536. path (a URI that
    pyarrow.fs can write; default: a new folder in the shared folder) and the tokenizer's file must be
    reachable from every executor.
    """
    spark = docs.sparkSession
    path = path or folder(spark, "shards")
    texts = docs.select("text")
    room = _reserved(texts, stride)
    size = max(1, sum(n for _, n in room.values()))
    shards = -(-size // (4 * shard_sequences))  # about a quarter of the room is used
    width = -(-size // shards)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        words, end = word_tokenizer(tokenizer), np.array([END_ID], "<u4").tobytes()
        first, most = room.get(TaskContext.get().partitionId(), (0, 0))
        rest, done = np.empty(0, "<u2"), 0

        def sequences(ids: np.ndarray, used: int) -> pd.DataFrame:
            count = len(ids) // stride
            if done + count > most:
                raise ValueError("the table's partitions changed between two scans")
            slots = permuted(np.arange(first + done, first + done + count), size, key)
            flat = ids.tobytes()
            cuts = [flat[2 * stride * i : 2 * stride * (i + 1)] for i in range(count)]
            n = np.full(count, stride)
            n[-1:] -= len(ids) - used
            return pd.DataFrame({"shard": (slots // np.uint64(width)).astype(np.int64), "slot": slots.astype(np.int64), "n": n, "ids": cuts})

        for frame in chunks(frames):
            new = np.frombuffer(b"".join(words.encode(t) + end for t in frame["text"]), "<u4")
            if len(new) and new.max() > 0xFFFF:
                raise ValueError("token ids beyond 2 bytes")
            rest = np.concatenate([rest, new.astype("<u2")])
            whole = len(rest) // stride * stride
            if whole:
                yield sequences(rest[:whole], whole)
                done += whole // stride
                rest = rest[whole:]
        if len(rest):
            yield sequences(np.concatenate([rest, np.full(stride - len(rest), PAD_ID, "<u2")]), len(rest))

    def write(frame: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        frame = frame.sort_values("slot")
        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base)
        shard = int(frame["shard"].iloc[0])
        name = f"shard-{shard:08d}.bin"
        content = shard_bytes(frame["slot"].to_numpy(), list(frame["ids"]), stride)
        own = f"{base}/.{name}-{uuid.uuid4().hex}"
        with store.open_output_stream(own) as out:
            out.write(content)
        store.move(own, f"{base}/{name}")
        row = (shard, name, len(frame), int(frame["n"].sum()), zlib.crc32(content), int(frame["slot"].iloc[0]), int(frame["slot"].iloc[-1]))
        return pd.DataFrame([row], columns=["shard", "file", "sequences", "ids", "crc32", "first_slot", "last_slot"])

    dealt = texts.mapInPandas(cut, "shard bigint, slot bigint, n bigint, ids binary")
    kinds = "shard bigint, file string, sequences bigint, ids bigint, crc32 bigint, first_slot bigint, last_slot bigint"
    manifest = stored(dealt.groupBy("shard").applyInPandas(write, kinds), "manifest")
    return path, manifest


def read_sequences(manifest: DataFrame, path: str) -> DataFrame:
    """(shard, place, slot, ids_crc32, n_ends) of every sequence, read from the shard files; n_ends counts document ends."""
    spark = manifest.sparkSession
    if manifest.isEmpty():
        return spark.createDataFrame([], "shard bigint, place bigint, slot bigint, ids_crc32 bigint, n_ends bigint")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(path)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                slots, ids = read_shard(content)
                yield pd.DataFrame(
                    {
                        "shard": int(name.rsplit("-", 1)[1].split(".")[0]),
                        "place": np.arange(len(slots)),
                        "slot": slots.astype(np.int64),
                        "ids_crc32": [zlib.crc32(row.tobytes()) for row in ids],
                        "n_ends": (ids == END_ID).sum(axis=1),
                    }
                )

    return files.select("path", "content").mapInPandas(read, "shard bigint, place bigint, slot bigint, ids_crc32 bigint, n_ends bigint")
