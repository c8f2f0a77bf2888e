import math
import random
import re
from collections import Counter

import pytest

from daymark.llm import pair_search
from daymark.llm.pair_search import build_index, search, terms_of
from tests.llm.conftest import EDGES


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))


def brute(docs, queries, top=20):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(c.total() for _, c in held)
    out = []
    for q, text in sorted(set(queries), key=str):
        scores = []
        for i, c in held:
            m = 75 + (25 * c.total() * n) // total
            score = 0
            for t in terms(text):
                if c[t]:
                    df = sum(1 for _, other in held if other[t])
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(q, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def asked(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_terms():
    for text in ("", None, "Ab-c1 É_ü\x00x\x7fy", "²3 a b C", "ÀB"):
        assert [t.decode() for t in terms_of(text)] == terms(text)


@pytest.mark.parametrize("block_docs, query_bytes", [(1 << 14, 8 << 20), (7, 8 << 20), (16, 60)])
def test_against_brute_force(spark, docs, monkeypatch, block_docs, query_bytes):
    monkeypatch.setattr(pair_search, "BLOCK_DOCS", block_docs)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    draw = lambda n: " ".join(words[min(int(rng.expovariate(0.12)), 39)] for _ in range(n))
    rows = [*EDGES, *[(i + 10, draw(rng.randint(1, 60))) for i in range(120)], *[(i + 200, "w1 w30 w2") for i in range(40)]]
    queries = [(1, "w1 w30 w2"), (2, draw(12)), (3, draw(3)), (4, "w5 w5 w5 w39"), (5, None), (6, "nowhere"), (7, "same text, WORD"), (7, "same text, WORD")]
    assert found(search(docs(rows), asked(spark, queries), query_bytes=query_bytes)) == brute(rows, queries)


def test_bounds_skip_and_stay_bounds(spark, docs):
    """The pair bound lies between the true maximum and the sum of the terms' maxima."""
    rows = [(i, "a b" if i % 2 else "a c") for i in range(40)] + [(100, "b c")]
    index = build_index(docs(rows))
    query = pair_search.Query(0, "b c a")
    lists = pair_search.BlockLists(pair_search.compile_lists(index.where("block = 0 or term = ''").coalesce(1), [query], 20).toPandas().query("block == 0"))
    known = sorted((t, 1) for t in query.terms if t in lists.lists)
    bounds, sums = lists.bounds(known, query), [0]
    for t, _ in known:
        sums.append(sums[-1] + lists.lists[t][2])
    assert all(b <= s for b, s in zip(bounds, sums))
    scores = lists.best(query, 0, 1)[1]
    assert not len(scores) or scores[0] <= bounds[-1]


def test_empty_tables(spark, docs):
    assert found(search(docs([(1, "a")]).limit(0), asked(spark, [(1, "a")]))) == []
    assert found(search(docs([(1, "a")]), asked(spark, [(1, "a")]).limit(0))) == []
    assert found(search(docs([(1, None), (2, "")]), asked(spark, [(1, "a")]))) == []


def test_long_text(spark, docs):
    rows = [(1, "x y " * 400_000 + "rare"), (2, "rare"), (3, "x")]
    assert found(search(docs(rows), asked(spark, [(1, "rare x")]))) == brute(rows, [(1, "rare x")])
