"""URL filters: a blocked Bloom filter passes possible hits to an exact hash join.

Listed entries are canonical URLs `host/path`. An entry fits its host and all subdomains of it
where the path starts with the entry's path; the longest entry wins. Every URL is turned into the
keys under which it could be listed (each suffix of its host by labels, each start of its path
that has the length of a listed path). The keys first probe the Bloom filter, a table of 64-bit
blocks, and only those that pass are joined with the list itself.

Everything is a DataFrame expression: no Python runs on the executors.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The filter never has more blocks than this (16 bytes each in a broadcast: 2 MB).
MAX_BLOCKS = 1 << 17
BITS_PER_KEY = 16
PROBES = 5


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _mask(key: Column) -> Column:
    """Bits of a key inside its block."""
    h = F.xxhash64(key, F.lit(1))
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int")) for i in range(PROBES)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, bits): one row for each block with a bit, so at most `blocks` rows."""
    return keys.groupBy(_block(F.col("key"), blocks).alias("block")).agg(F.bit_or(_mask(F.col("key"))).alias("bits"))


def block_count(n_keys: int, max_blocks: int = MAX_BLOCKS) -> int:
    wanted = 1
    while wanted * 64 < n_keys * BITS_PER_KEY and wanted < max_blocks:
        wanted *= 2
    return wanted


def judge_urls(
    pages: DataFrame, listed: DataFrame, url: str = "url", default: str = "allow", max_blocks: int = MAX_BLOCKS
) -> DataFrame:
    """`pages` with the columns host, path, rule and verdict.

    listed: (rule string `host/path`, verdict string). Null rules are left out; of repeated rules the
    smallest verdict holds. Of entries that fit, the longest wins; of equally long ones the one
    with the longer host. rule is null and verdict `default` where no
    entry fits. A null URL, or one without `://`, has an empty host and path and fits nothing.
    Input columns named host, path, rule or verdict are replaced, others kept. Empty tables give no
    rows; an empty list gives `default` everywhere. Repeated rows stay repeated.
    """
    rules = (
        listed.where("rule IS NOT NULL")
        .groupBy("rule")
        .agg(F.min("verdict").alias("verdict"))
        .select(F.col("rule").alias("key"), "verdict", F.length(F.regexp_extract("rule", r"(?s)^[^/]*(.*)$", 1)).alias("n_path"))
    )
    known = rules.agg(F.count("*").alias("n"), F.array_sort(F.collect_set("n_path")).alias("lengths")).first()
    blocks = block_count(known["n"], max_blocks)
    kept = pages.drop("host", "path", "rule", "verdict")
    rows = kept.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    lengths = F.array(*(F.lit(n) for n in known["lengths"])).cast("array<int>")
    starts = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n)
    )
    candidates = (
        rows.where("host <> ''")
        .select("host", "path")
        .distinct()
        .withColumn("suffix", F.explode(suffixes))
        .withColumn("start", F.explode(starts))
        .select("host", "path", F.concat("suffix", "start").alias("key"))
    )
    possible = (
        candidates.withColumn("block", _block(F.col("key"), blocks))
        .join(F.broadcast(bloom_blocks(rules, blocks)), "block")
        .where(F.col("bits").bitwiseAND(_mask(F.col("key"))) == _mask(F.col("key")))
    )
    best = F.struct(F.length("key").alias("n"), (-F.col("n_path")).alias("h"))
    judged = (
        possible.join(rules, "key")
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("key", "verdict"), best).alias("hit"))
        .select("host", "path", F.col("hit.key").alias("rule"), F.col("hit.verdict").alias("verdict"))
    )
    return rows.join(judged, ["host", "path"], "left").select(
        *(F.col(c) for c in kept.columns), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
