"""Shards by jump consistent hashing, in expressions only.

The hash draws jumps from a 64-bit linear generator that the key seeds: a key moves to shard j when
the number of shards passes j, so that shard j takes rows from all others in equal parts and no row
moves between the others. There is no table of the ring, and one walk gives the shard for every
smaller number of shards. Spark has no wrapping product of 64 bits under its strict arithmetic, so
the generator's state is kept as two halves of 32 bits.

Numbers inside a shard need a count of the rows before: rows equal in all columns are counted
first, the rest is dealt into ranges of the order (which split a key or text with many rows), and the counts of
the ranges are added up by shard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.llm.shared import folder, stored, tasks

# Factor of the published jump hash, as 32-bit halves and the lower one as 16-bit halves.
FACTOR = 2862933555777941757
_HIGH, _LOW = FACTOR >> 32, FACTOR & 0xFFFFFFFF
_LOW_HIGH, _LOW_LOW = _LOW >> 16, _LOW & 0xFFFF
#: Rows that are numbered in one task, about.
RANGE_ROWS = 200_000
#: Copies of one row that are written out in one go.
COPIES = 1 << 16

RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _drawn(high: Column, low: Column) -> tuple[Column, Column]:
    """Halves of state * FACTOR + 1, modulo 2^64. No sum passes 63 bits."""
    mask, short = _long(0xFFFFFFFF), _long(0xFFFF)
    p, q = low * _LOW_LOW, low * _LOW_HIGH
    bottom = p + F.shiftleft(q.bitwiseAND(short), 16) + 1
    carry = F.shiftright(bottom, 32) + F.shiftright(q, 16)
    r, s = high * _LOW_LOW, high * _LOW_HIGH
    top = carry + low * _HIGH + r + F.shiftleft(s.bitwiseAND(short), 16)
    return top.bitwiseAND(mask), bottom.bitwiseAND(mask)


def key_halves(key: Column, kind: str) -> tuple[Column, Column]:
    """The 64 bits of a key: integers as they are, anything else through a hash; null counts as 0."""
    whole = key.cast("bigint") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(key)
    bits = F.coalesce(F.when(key.isNotNull(), whole), _long(0))
    return F.shiftrightunsigned(bits, 32), bits.bitwiseAND(_long(0xFFFFFFFF))


def jump(high: Column, low: Column, shards: int) -> Column:
    """Struct (shard, grown): the key's shard among `shards`, and among one more.

    The walk has at most `shards` jumps (about their logarithm, on average); it runs in a loop of
    loops, each of the square root's length, and the inner ones of a finished walk are passed over.
    """
    state = F.struct(
        high.alias("high"), low.alias("low"), _long(0).alias("shard"), _long(0).alias("grown"), _long(0).alias("next")
    )
    done = lambda s: s["next"] > shards

    def step(s: Column, _: Column) -> Column:
        high, low = _drawn(s["high"], s["low"])
        share = F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double")
        moved = F.struct(
            high.alias("high"),
            low.alias("low"),
            F.when(s["next"] < shards, s["next"]).otherwise(s["shard"]).alias("shard"),
            s["next"].alias("grown"),
            F.floor((s["next"] + 1).cast("double") * share).alias("next"),
        )
        return F.when(done(s), s).otherwise(moved)

    rounds = F.sequence(F.lit(1), F.lit(math.isqrt(shards) + 2))
    walked = F.aggregate(rounds, state, lambda s, i: F.when(done(s), s).otherwise(F.aggregate(rounds, s, step)))
    return F.struct(walked["shard"].cast("int").alias("shard"), walked["grown"].cast("int").alias("grown"))


def assign_shards(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: key, carried columns, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 1 and text_crc32 its checksum (0 for a null text, which has no
    bytes). law is `key`: the key and the number of shards alone decide, so repeated rows and keys
    share a shard, and a null key counts as 0. slot numbers a shard's rows from 0 in the order of a
    spread of the key, checksum, size and key; rows equal in all of these and in the carried columns
    are interchangeable. grown_shard is the shard with one more. Columns of docs that are not carried
    are left out, and carried ones may not have a name of the result. An empty table gives no rows.
    """
    clash = {*RESULT, "spread", "copies", "part", "first", "block"} & {key, *carry}
    if clash:
        raise ValueError(f"names of the result: {sorted(clash)}")
    spark = docs.sparkSession
    high, low = key_halves(F.col(key), dict(docs.dtypes)[key])
    body = F.coalesce(F.col(text), F.lit(""))
    facts = docs.select(
        key,
        *[c for c in carry if c != key],
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"),
        _drawn(high, low)[0].alias("spread"),
    )
    # Copies are counted before anything is ordered; only then each distinct row walks.
    counted = stored(facts.groupBy(*facts.columns).agg(F.count("*").alias("copies")), "shard-rows")
    walked = counted.withColumn("_jump", jump(*key_halves(F.col(key), dict(docs.dtypes)[key]), shards))
    placed = walked.select(*counted.columns, "_jump.shard", F.col("_jump.grown").alias("grown_shard"))
    order = ["spread", "text_crc32", "size", key, *[c for c in carry if c != key]]
    total = counted.count()
    ranges = max(min(total, tasks(spark)), -(-total // RANGE_ROWS), 1)
    dealt = placed.repartitionByRange(ranges, "shard", *order).withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, "shard-ranges")
    sums = dealt.groupBy("shard", "part").agg(F.sum("copies").alias("held"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("shard", "part", F.coalesce(F.sum("held").over(before), _long(0)).alias("start"))
    within = Window.partitionBy("shard", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = (
        dealt.withColumn("first", F.coalesce(F.sum("copies").over(within), _long(0)))
        .join(starts, ["shard", "part"])
        .withColumn("first", F.col("first") + F.col("start"))
    )
    few = numbered.where(F.col("copies") <= COPIES).withColumn("block", F.lit(0).cast("bigint"))
    many = numbered.where(F.col("copies") > COPIES)
    many = many.withColumn("block", F.explode(F.sequence(_long(0), F.expr(f"(copies - 1) div {COPIES}"))))
    rows = few.unionByName(many.repartition(tasks(spark), "shard", "first", "block"))
    own = F.least(F.col("copies") - F.col("block") * COPIES, _long(COPIES))
    rows = rows.withColumn("copy", F.explode(F.sequence(_long(0), own - 1)))
    return rows.select(
        key,
        *[c for c in carry if c != key],
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("first") + F.col("block") * COPIES + F.col("copy")).alias("slot"),
        "grown_shard",
    )


def write_shards(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", path: str | None = None) -> str:
    """Write the documents into a folder shard=K for each shard, files in the order of the slots; returns the path.

    Columns of docs named as a result column, or as a helper of assign_shards, are left out.
    """
    path = path or folder(docs.sparkSession, "shards")
    own = {*RESULT, "spread", "copies", "part", "first", "block"}
    carry = tuple(c for c in docs.columns if c not in own and c != key)
    rows = assign_shards(docs, shards, key, text, carry)
    ordered = rows.repartitionByRange(max(shards, tasks(docs.sparkSession)), "shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
    return path
