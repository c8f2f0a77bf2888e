import collections
import random

import pytest
from tests.llm.conftest import EDGES

from daymark.llm import suffix_dedup
from daymark.llm.suffix_dedup import remove_repeats


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        covered = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        out.append(bytes(b for b, c in zip(d, covered, strict=True) if not c))
    return out


def texts_with_repeats(seed):
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared = [noise(120) for _ in range(3)]
    out = []
    for i in range(40):
        parts = [noise(rng.randint(0, 150)), rng.choice(shared)[rng.randint(0, 30) : rng.randint(60, 120)], noise(rng.randint(0, 100))]
        out.append("".join(parts))
    near = noise(300)
    out += [near[:k] + "X" + near[k + 1 :] for k in rng.sample(range(300), 12)]
    out += ["a" * 150, "ab" * 90, "a" * 39, near, near, None, ""]
    return out


@pytest.mark.parametrize("hot", [16384, 2])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(docs, hot, seed):
    texts = texts_with_repeats(seed)
    found = remove_repeats(docs(list(enumerate(texts))), length=40, anchor=12, hot=hot).select("doc_id", "kept").collect()
    assert [bytes(r.kept) for r in sorted(found)] == brute(texts, 40)


def test_parts_of_long_texts(docs, monkeypatch):
    text = "".join(random.Random(3).choice("abc ") for _ in range(5000))
    monkeypatch.setattr(suffix_dedup, "PART", 512)
    low = {(first + p.low[i], first + p.high[i]) for first, p in suffix_dedup.parts(text.encode(), 40, 12) for i in range(len(p.low))}
    places = sorted(x for a, b in low for x in range(a, b + 1))
    assert places == list(range(5000 - 39))


def test_edges(docs):
    found = remove_repeats(docs(EDGES + [(9, "long " * 60), (9, "long " * 60)])).toPandas()
    assert len(found) == len(EDGES) + 2
    assert [bytes(k) for k in found[found.doc_id == 9].kept] == [b"", b""]
    assert [list(r) for r in found[found.doc_id == 9].runs] == [[0, 300], [0, 300]]
    assert bytes(found[found.doc_id == 1].kept.iloc[0]) == b"" and found["mask"].tolist() == ["z"] * len(found)
    assert remove_repeats(docs(EDGES).limit(0)).count() == 0


