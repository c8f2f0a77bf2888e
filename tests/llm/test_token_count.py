import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tests.llm.conftest import EDGES

from daymark.llm.token_count import count_tokens, transducer

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=PATH)
TEXTS = [
    "", " ", "  ", "a  b", " a", "a ", "a \n b", "\n\n", "日本語のテキスト", "🙂🙂 x", "</s> <s> <unk> <0x0A>", "a" * 300, "▁▁ a▁b", "x" * 5000,
    "\t\t  \t a\x00b", "    def f(x):\n        return x  # ok", "…—“”é́", "thanthether " * 50,
]


def test_texts():
    for text in TEXTS:
        assert transducer(PATH).count(text) == len(LIBRARY.encode(text)), text


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="etaoinshr ▁\n.,0é日", max_size=60))
def test_any_text(text):
    assert transducer(PATH).count(text) == len(LIBRARY.encode(text))


def test_forgetting_transitions_changes_nothing(monkeypatch):
    from daymark.llm import token_count

    monkeypatch.setattr(token_count, "MAX_TRANSITIONS", 20)
    machine = token_count.Transducer(PATH)
    for text in TEXTS:
        assert machine.count(text) == len(LIBRARY.encode(text))


def test_rows(docs):
    found = count_tokens(docs(EDGES + [(7, "word " * 5000)]), PATH).toPandas()
    assert len(found) == len(EDGES) + 1 and found["mask"].notna().all()
    assert found[found.doc_id == 1][["n_bytes", "n_tokens"]].values.tolist() == [[0, 0]]
    assert found[found.doc_id == 6].n_bytes.tolist() == [60]
    assert found[found.doc_id == 7].over_limit.tolist() == [True] and found.over_limit.sum() == 1
    assert count_tokens(docs(EDGES).limit(0), PATH).count() == 0
