import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daymark.llm import sharding
from daymark.llm.sharding import assign_shards, jump, key_halves, write_shards
from tests.llm.conftest import EDGES


def brute(key, shards):
    state, place, following = key % (1 << 64), -1, 0
    while following < shards:
        place = following
        state = (state * sharding.FACTOR + 1) % (1 << 64)
        following = int((place + 1) * (float(1 << 31) / float((state >> 33) + 1)))
    return place


@pytest.mark.parametrize("shards", [1, 2, 16, 1000])
def test_against_brute_force(spark, shards):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(100, 160), *(7**k % 2**62 for k in range(60))]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    found = df.select("k", jump(*key_halves(F.col("k"), "bigint"), shards).alias("j")).collect()
    assert [(r.j.shard, r.j.grown) for r in found] == [(brute(r.k, shards), brute(r.k, shards + 1)) for r in found]


def test_shares_are_even_and_only_the_new_shard_gains(spark):
    df = spark.range(20_000).select("id", jump(*key_halves(F.col("id"), "bigint"), 16).alias("j")).select("id", "j.*")
    rows = df.collect()
    moved = [r for r in rows if r.shard != r.grown]
    assert all(r.grown == 16 for r in moved) and abs(len(moved) - 20_000 / 17) < 150
    assert all(abs(n - 1250) < 150 for n in Counter(r.shard for r in rows).values())


@pytest.mark.parametrize("copies", [1 << 16, 3])
def test_slots(spark, docs, monkeypatch, copies):
    monkeypatch.setattr(sharding, "COPIES", copies)
    monkeypatch.setattr(sharding, "RANGE_ROWS", 10)
    rows = [*EDGES, *[(7, "one text")] * 40, *[(8, f"text {i}") for i in range(40)], (None, "no id at all")]
    found = assign_shards(docs(rows)).collect()
    expected = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), brute(i or 0, 16), brute(i or 0, 17)) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in found) == expected
    by_shard = {}
    for r in found:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())


def test_written_shards_hold_every_row_in_order(spark, docs):
    rows = [*EDGES, *[(i, f"text {i}") for i in range(50)]]
    path = write_shards(docs(rows), 4)
    found = spark.read.parquet(path)
    assert Counter((r.doc_id, r.text) for r in found.collect()) == Counter(rows)
    assert {"runs", "verdict", "mask", "kept", "n"} <= set(found.columns)
    assert all(r.shard == brute(r.doc_id or 0, 4) for r in found.collect())


def test_keys_of_text_and_empty_tables(spark, docs):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "z"), (None, None)], "name string, text string")
    found = assign_shards(df, 5, key="name").collect()
    assert len(found) == 4 and len({r.shard for r in found if r.name == "a"}) == 1
    assert assign_shards(docs([(1, "x")]).limit(0)).count() == 0
    with pytest.raises(ValueError):
        assign_shards(df.withColumnRenamed("name", "slot"), 5, key="slot")


def test_no_python_in_the_plan(spark, docs):
    plan = assign_shards(docs(EDGES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
