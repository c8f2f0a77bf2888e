import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import EDGES

from daymark.llm.packing import first_fit_decreasing, pack_documents, word_tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "It's <|endoftext|> THE end…  of\tthe　world, É.É ÉCOLE é.É d’or 12,3. ﬁn µ ª º ÿ ŸÀ ΑΣ. Σ, İx",
    "x\x1cy z\x85q áb \x00 'S don'T <|STARTOFTEXT|>", " ", "\n\n", "!!!...,,, a.,b ., . , A.,", "日本語 テキスト", "straße Weiß. naïve, İİ",
]


def whole(text):
    return word_tokenizer(PATH).tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_words_give_the_ids_of_whole_texts(text):
    assert np.frombuffer(word_tokenizer(PATH).encode(text), "<u4").tolist() == whole(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aBéÉ .,'s\n\t1!<|>ßª\u0301Σ", max_size=40))
def test_words_give_the_ids_of_any_text(text):
    assert np.frombuffer(word_tokenizer(PATH).encode(text), "<u4").tolist() == whole(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=60))
def test_first_fit_decreasing_is_the_plain_rule(sizes):
    bins, offsets = first_fit_decreasing(np.array(sizes), 50)
    free, want = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((b for b, f in enumerate(free) if f >= sizes[i]), len(free))
        if b == len(free):
            free.append(50)
        want[i] = (b, 50 - free[b])
        free[b] -= sizes[i]
    assert [(b, o) for b, o in zip(bins.tolist(), offsets.tolist(), strict=True)] == [want[i] for i in range(len(sizes))]


def test_pieces_cover_documents_and_sequences(docs):
    texts = [(i, "the quick brown fox " * (1 + 37 * i % 400)) for i in range(60)] + [(100 + i, t) for i, t in enumerate(TEXTS)]
    found = pack_documents(docs(texts), PATH, capacity=256, group_documents=16).toPandas()
    for doc, text in texts:
        ids = np.array([*whole(text), 2], "<u4")
        own = found[found.doc_id == doc].sort_values("start")
        assert own.start.tolist() == [0, *np.cumsum(own.length)[:-1]] and own.length.sum() == len(ids)
        assert (own.doc_tokens == len(ids)).all()
        for row in own.itertuples():
            assert row.ids_crc32 == zlib.crc32(ids[row.start : row.start + row.length].tobytes())
    for _, rows in found.sort_values("offset").groupby("sequence_id"):
        assert rows.offset.tolist() == [0, *np.cumsum(rows.length)[:-1]] and rows.length.sum() <= 256
    assert found.sequence_id.nunique() * 256 < 1.1 * found.length.sum() + 256 * 5


def test_edges(docs):
    found = pack_documents(docs(EDGES), PATH).toPandas()
    assert len(found) == len(EDGES)
    assert found[found.doc_id == 1].doc_tokens.tolist() == [1] and found[found.doc_id == 2].doc_tokens.tolist() == [1]
    assert found.doc_id.isna().sum() == 1
    assert pack_documents(docs(EDGES).limit(0), PATH).count() == 0


def test_random_letters_and_marks_give_the_ids_of_the_library():
    rng = random.Random(6)
    letters = "aAbBzZéÉßÄÿµªºÆ×÷.,;!:?$%&*#|()'<|>endoftextSTART 019 \n\t\xa0\xadİıẞΩéx̀中"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        if rng.random() < 0.1:
            text += rng.choice(["<|endoftext|>", "<|ENDOFTEXT|>", "'S 'Ll don't DON'T", "abc***", "é&&&."])
        assert np.frombuffer(word_tokenizer(PATH).encode(text), "<u4").tolist() == whole(text)
