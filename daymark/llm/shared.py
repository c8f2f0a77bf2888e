"""Helpers of several operators: the shared folder, caches inside tasks, hashes of words."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Odd constants that mix 64-bit hashes (fixed values of a public integer mixer).
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Multiplier of the polynomial that joins word hashes into shingle hashes.
BASE = np.uint64(0x9E3779B97F4A7C15)


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder that the session names in spark.checkpoint.dir.

    Only where the session names none (tests on one machine) is a temporary folder set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = tempfile.mkdtemp(prefix="daymark-shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage is cut and its size known."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of rows that go to a Python worker together, as many as its helpers work on at once.
BATCH_BYTES = 2 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of BATCH_BYTES, in this session from now on, unless it names a size itself.

    Spark's 10,000 rows or 64 MB stand several times in a task: in Arrow buffers outside the heap, as what
    the worker reads, and as its strings. Batches bound memory only; no result depends on them.
    """
    if not spark.conf.get(_BATCH_SETTING, None):
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def tasks(spark: SparkSession) -> int:
    """Partitions for a key shuffle of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunks(frames: Iterator[pd.DataFrame], column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches so that each part holds about `limit` characters of text; null becomes the empty text."""
    for frame in frames:
        frame = frame.assign(**{column: [t if isinstance(t, str) else "" for t in frame[column]]})
        sizes = np.fromiter(map(len, frame[column]), np.int64, len(frame))
        cuts = np.cumsum(sizes) // limit
        for _, rows in frame.groupby(cuts, sort=False):
            yield rows


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(30))
    h = h * MIX_A
    h ^= h >> np.uint64(27)
    h *= MIX_B
    return h ^ (h >> np.uint64(31))


class Generations(dict):
    """A cache of at most 2 x `limit` entries: a full one becomes the old one, hits in the old one move up."""

    def __init__(self, make, limit: int = 150_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


#: Bytes hashed together.
_SLICE = 1 << 19
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))


@lru_cache(maxsize=1)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse."""
    out = []
    for base in (int(BASE), pow(int(BASE), -1, 1 << 64)):
        powers = np.full(length, base, np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers, dtype=np.uint64))
    return out[0], out[1]


def _slice_hashes(data: np.ndarray, spaces: np.ndarray) -> np.ndarray:
    edges = np.flatnonzero(np.diff(~spaces[data], prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(max(2 * _SLICE, 1 << len(data).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hashed_words(text: bytes, spaces: np.ndarray) -> np.ndarray:
    """64-bit hash of each word of a text, the same on every executor; spaces marks the bytes that separate.

    Long texts are read in slices that end between words.
    """
    data, out, start = np.frombuffer(text, np.uint8), [], 0
    while start < len(data):
        end = min(start + _SLICE, len(data))
        while end < len(data) and not spaces[data[end]]:
            end += 1
        out.append(_slice_hashes(data[start:end], spaces))
        start = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def batch_hashes(texts: list[bytes], spaces: np.ndarray, joint: bytes = b" ") -> list[np.ndarray]:
    """hashed_words of each text; short texts are hashed together. joint is one separating byte."""
    found: list[np.ndarray] = []
    group: list[bytes] = []
    held = 0

    def flush() -> None:
        if not group:
            return
        data = np.frombuffer(joint.join(group) + joint, np.uint8)
        every = _slice_hashes(data, spaces)
        cuts = np.cumsum([len(t) + 1 for t in group])[:-1]
        starts = ~spaces[data] & np.concatenate([[True], spaces[data[:-1]]])
        found.extend(np.split(every, np.cumsum(starts)[cuts - 1]))

    for text in texts:
        if held and held + len(text) > _SLICE:
            flush()
            group, held = [], 0
        if len(text) > _SLICE:
            found.append(hashed_words(text, spaces))
            continue
        group.append(text)
        held += len(text)
    flush()
    return found


def word_bytes() -> np.ndarray:
    """Separators of words in most operators: ASCII white space."""
    return byte_set(b" \t\n\x0b\x0c\r")


def byte_set(separators: bytes) -> np.ndarray:
    marked = np.zeros(256, bool)
    marked[list(separators)] = True
    return marked


def rolled(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive word hashes, in order."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out *= BASE
        out += h[i : i + n]
    return mixed(out)


#: Bits of the filters that keep rows without a partner from being shuffled (4 MB).
FILTER_BITS = 1 << 25


class KeyFilter:
    """Passes every listed key, and others with a small chance."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def passes(self, keys: np.ndarray) -> np.ndarray:
        held = np.ones(len(keys), bool)
        for shift in (np.uint64(0), np.uint64(32)):
            slot = (keys >> shift) & np.uint64(FILTER_BITS - 1)
            held &= (self.bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
        return held


def key_filter(keys: DataFrame, column: str):
    """Broadcast filter of a column; at most FILTER_BITS / 64 words come to the driver."""
    slots = F.explode(F.array(*(F.shiftrightunsigned(column, s).bitwiseAND(FILTER_BITS - 1) for s in (0, 32))))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("slot").bitwiseAND(63).cast("int"))
    words = keys.select(slots.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found, bits = words.toArrow().to_pandas(), np.zeros(FILTER_BITS // 64, np.int64)
    bits[found["word"]] = found["bits"]
    return keys.sparkSession.sparkContext.broadcast(KeyFilter(bits.view(np.uint64)))


def passing(known):
    """A function of a column of keys: does the broadcast filter pass them?"""

    @F.pandas_udf("boolean")
    def passes(keys: pd.Series) -> pd.Series:
        return pd.Series(known.value.passes(keys.to_numpy(np.int64).view(np.uint64)))

    return passes


def appended(df: DataFrame, columns: list[str], make, fields: str, limit: int = BATCH_BYTES) -> DataFrame:
    """df with further columns, computed by make for about `limit` characters of rows at a time.

    make gets a list of values for each of `columns`, of which the first is a text (null as the empty
    text), and returns one list or array for each of `fields` ("name type, ..."). Columns of these
    names are replaced. All others pass through as they are, in Arrow form.
    """
    names = [f.split()[0] for f in fields.split(", ")]
    stay = [c for c in df.columns if c not in names]
    schema = T.StructType([*df.select(*stay).schema, *T.StructType.fromDDL(fields)])
    kinds = to_arrow_schema(schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]
            texts = values[0] = [t if t is not None else "" for t in values[0]]
            start = size = 0
            for i, text in enumerate(texts):
                size += len(text)
                if size >= limit or i == len(texts) - 1:
                    found = make(*(v[start : i + 1] for v in values))
                    new = [pa.array(x, kinds.field(n).type) for n, x in zip(names, found, strict=True)]
                    part = batch.select(stay).slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*stay, *names])
                    start, size = i + 1, 0

    return df.mapInArrow(add, schema)
