import random
import re
from collections import Counter

import numpy as np
import pytest

from daymark.llm import collocations
from daymark.llm.collocations import frequent_phrases, mine
from tests.llm.conftest import EDGES


def brute(rows, least, covered=80, top=2000):
    """rows: (text, lang)."""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        body = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", body):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    held = {g: a for g, a in counts.items() if a >= least}
    out = []
    for (lang, *words), a in held.items():
        if len(words) < 2:
            continue
        longer = [b for (other, *w), b in held.items() if other == lang and len(w) > len(words) and any(w[i : i + len(words)] == words for i in range(len(w)))]
        if any(100 * b >= covered * a for b in longer):
            continue
        cuts = [(2_000_000 * a // (held[lang, *words[:k]] + held[lang, *words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, held[lang, *words[:k]], held[lang, *words[k:]], totals[lang], score))
    ranked = []
    for lang in sorted({o[0] for o in out}):
        own = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))[:top]
        ranked += [(lang, i + 1, *o[1:]) for i, o in enumerate(own)]
    return ranked


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "a-b", "x\x1fy"]
    phrases = ["red hot chili pepper", "new york", "New York city", "in the end of"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(phrases) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randint(0, 30))]
        rows.append(("".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\r\n"]) for p in parts), rng.choice(["en", "en", "de", "EN", None])))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, "taken") for i, (t, g) in enumerate(rows)], "doc_id bigint, text string, lang string, phrase string")


def found(df):
    return [tuple(r) for r in df.orderBy("lang", "rank").collect()]


@pytest.mark.parametrize("sample, held, bits", [(4, 3 << 20, 1 << 28), (50, 40, 1 << 28), (3, 3 << 20, 64), (10**9, 40, 1 << 28)])
def test_against_brute_force(spark, monkeypatch, sample, held, bits):
    """Small and empty samples, whose border fails in every pass, and a filter that passes almost everything."""
    monkeypatch.setattr(collocations, "HELD", held)
    monkeypatch.setattr(collocations, "MAX_BITS", bits)
    rows = corpus(1) + [(t, "en") for _, t in EDGES] + [("new york again", "en")] * 30
    assert found(mine(table(spark, rows), least=8, sample=sample)) == brute(rows, 8)


def test_a_missed_phrase_is_found_with_its_extensions(spark):
    """Nothing is sampled, so every pass finds failures of the border until four words are counted."""
    rows = [("one two three four", "en")] * 30
    known = frequent_phrases(table(spark, rows).select("lang", "text", "doc_id"), 30, 10**9).collect()
    assert {(r.phrase, r.n) for r in known if r.k == 4} == {("one two three four", 30)}
    assert found(mine(table(spark, rows))) == brute(rows, 30) == [("en", 1, "one two three four", 30, 30, 30, 120, 1_000_000)]


def test_limit_and_cover(spark):
    rows = corpus(2)
    for covered, top in ((80, 5), (101, 2000), (20, 2000)):
        assert found(mine(table(spark, rows), least=6, covered=covered, top=top)) == brute(rows, 6, covered, top)


def test_empty_tables_and_long_text(spark):
    assert found(mine(table(spark, [("a b", "en")]).limit(0))) == []
    assert found(mine(table(spark, [(None, None), ("", "en")]))) == []
    rows = [("ab cd. " * 300_000, None)]
    assert found(mine(table(spark, rows))) == [("und", 1, "ab cd", 300_000, 300_000, 300_000, 600_000, 1_000_000)]


def test_hashes_keep_their_length():
    passage = collocations.Passage(["a b c d e. f", "g h"], "en")
    for k, h, places in passage.phrases():
        assert set((h & np.uint64(3)).tolist()) <= {k - 1}
        assert len(places) == max(5 - k + 1, 0) + max(2 - k + 1, 0) + (k == 1)
