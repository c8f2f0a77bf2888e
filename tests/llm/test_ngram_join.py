import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import EDGES

from daymark.llm import ngram_join
from daymark.llm.components import components
from daymark.llm.ngram_join import keep_representatives, near_components


def sets_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    sets, root = {i: sets_of(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and 100 * len(x & y) >= 80 * len(x | y):
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed, n=150):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("aeiou") + rng.choice("xyzw")
    passage = [word() for _ in range(25)]
    bases = [[word() for _ in range(60)] for _ in range(4)]
    out = []
    for i in range(n):
        words = list(bases[i % 4]) if i % 3 else [word() for _ in range(40)] + passage
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = word()
        out.append((i, " ".join(words).upper() if i % 7 == 0 else " ".join(words)))
    return out + [(n + 1, "a b"), (n + 2, "A  B\n"), (n + 3, ""), (n + 4, None), (n + 5, "a b c d e"), (n + 6, "one")]


@pytest.mark.parametrize("pairs_per_row", [8, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(docs, monkeypatch, seed, pairs_per_row):
    monkeypatch.setattr(ngram_join, "PAIRS_PER_ROW", pairs_per_row)
    rows = near_copies(seed)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_components(docs(rows)).collect()}
    assert found == brute(rows)


def test_chains_stay_connected(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    more = edges.union(spark.createDataFrame([(200, 100), (100, 200), (7, 7)], "a bigint, b bigint"))
    roots = {r.node: r.root for r in components(more).collect()}
    assert roots == {i: 0 for i in range(61)} | {100: 100, 200: 100}


def test_edges(docs):
    found = near_components(docs(EDGES)).collect()
    assert len(found) == len(EDGES)
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert by[1] == (0, 1) and by[3] == (1, 3) and by[5] == (1, 5) and by[None] == (1, None)
    assert near_components(docs(EDGES).limit(0)).count() == 0
    kept = keep_representatives(docs(EDGES + [(50, "same text here")]))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6]
    assert kept.columns == docs(EDGES).columns


def test_texts_of_one_id_and_texts_without_an_id(docs):
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    near = a.replace("a59", "other")
    rows = [(3, a), (7, near), (7, b), (None, c), (None, c), (None, c.replace("c59", "other")), (None, a), (9, b), (None, ""), (None, "")]
    kept = keep_representatives(docs(rows)).collect()
    assert sorted((r.doc_id or 0, (r.text or "")[:1]) for r in kept) == [(0, ""), (0, ""), (0, "c"), (3, "a"), (7, "b")]


def test_marks_bound_the_difference():
    rng = np.random.default_rng(1)
    for n in (0, 5, 170, 3000):
        base = rng.integers(0, 1 << 63, n).astype(np.uint64)
        for changed in (0, 1, n // 10, n // 3):
            other = base.copy()
            other[:changed] = rng.integers(0, 1 << 63, changed).astype(np.uint64)
            bits = sum(((a ^ b) & ((1 << 64) - 1)).bit_count() for a, b in zip(ngram_join._marks(base), ngram_join._marks(other)))
            assert bits <= len(set(base.tolist()) ^ set(other.tolist()))


def test_a_group_of_copies_whose_pairs_mostly_fail(spark, docs, monkeypatch):
    """Each copy changes other words, so that neighbours in number of changes link and most pairs don't."""
    rng = random.Random(7)
    base = [f"b{i}" for i in range(170)]
    rows = []
    for i in range(60):
        words = base[:]
        for place in rng.sample(range(170), rng.choice([1, 3, 4, 5])):
            words[place] = f"x{i}-{place}"
        rows.append((i, " ".join(words)))
    seen = []
    product = ngram_join._product
    monkeypatch.setattr(ngram_join, "_product", lambda *a: seen.append(product(*a)) or seen[-1])
    monkeypatch.setattr(ngram_join, "PAIRS_PER_ROW", 10**9)
    found = {r.doc_id: r.component_id for r in ngram_join.near_components(docs(rows).select("doc_id", "text")).collect()}
    sets = [set(zip(*(t.split()[k:] for k in range(5)))) for _, t in rows]
    parent = list(range(60))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(60):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert found == {i: root(i) for i in range(60)}
    assert seen and seen[0].count() < 60 * 59 / 4
