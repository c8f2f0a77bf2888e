import hashlib
import random
import re

import pytest
from tests.llm.conftest import EDGES

from daymark.llm.decontaminate import find_contamination, word_hashes


def words_of(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words_of(text)
        n = min(10, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[a : a + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                if own := windows.get(tuple(w[a : a + n])):
                    hit |= set(range(a, a + n))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return out


ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven twelve thirteen"),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    (3, "short item"), (4, ""), (5, None), (3, "short item"), (10, "é Ü"), (11, "the the the the the the the the the the the the"),
]


def planted():
    rng, out = random.Random(5), list(EDGES)
    pool = " ".join(t for _, t in ITEMS if t).split()
    for i in range(60):
        noise = [rng.choice(pool + ["noise", "x"]) for _ in range(rng.randint(0, 30))]
        item = (ITEMS[rng.randrange(3)][1] or "").split()
        a = rng.randint(0, 3)
        out.append((100 + i, " -- ".join(noise + [w.upper() for w in item[a:]] + noise[:5])))
    return out + [(200, "the " * 40), (201, "theshort item"), (202, "nine SHORT, item!")]


@pytest.mark.parametrize("block_bytes", [8 << 20, 60])
def test_against_brute_force(spark, docs, block_bytes):
    rows = planted()
    benchmark = spark.createDataFrame([(*i, "c") for i in ITEMS], "item_id bigint, text string, items string")
    found = find_contamination(docs(rows), benchmark, block_bytes)
    got = found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    key = lambda r: (r[0] or 0, *map(str, r[1:]))
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, ITEMS), key=key)
    assert "mask" in found.columns


def test_empty(spark, docs):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert find_contamination(docs(EDGES).limit(0), benchmark).count() == 0
    assert find_contamination(docs(EDGES), benchmark.limit(0)).where("contaminated").count() == 0


def test_words():
    split, one = word_hashes(["A-b_c9 É\x7fz", "a b c9 É z"])
    assert split.tolist() == one.tolist() and len(set(one.tolist())) == 5
