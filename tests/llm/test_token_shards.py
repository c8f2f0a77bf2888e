import numpy as np
import public_tokenizers
import pytest
from tests.llm.conftest import EDGES

from daymark.llm.packing import word_tokenizer
from daymark.llm.token_shards import END_ID, permuted, read_sequences, read_shard, write_shards

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("size", [1, 2, 3, 10, 1000, 65537])
def test_permutation(size):
    numbers = np.arange(size)
    out = permuted(numbers, size, 5)
    assert sorted(out.tolist()) == numbers.tolist()
    assert (permuted(out, size, 5, back=True) == numbers).all()
    if size >= 1000:
        assert (out != permuted(numbers, size, 6)).any() and abs(np.corrcoef(numbers, out.astype(float))[0, 1]) < 0.2


def test_round_trip(spark, docs, tmp_path):
    texts = EDGES + [(10 + i, f"document number {i} " + "the fox " * (i * 13 % 90)) for i in range(80)]
    path, manifest = write_shards(docs(texts).repartition(3), PATH, str(tmp_path / "out"), stride=64, shard_sequences=10)
    again, second = write_shards(docs(texts).repartition(3), PATH, str(tmp_path / "again"), stride=64, shard_sequences=10)
    rows = manifest.toPandas().sort_values("shard")
    assert rows.crc32.tolist() == second.toPandas().sort_values("shard").crc32.tolist()
    slots, ids = [], []
    for name in rows.file:
        content = (tmp_path / "out" / name).read_bytes()
        found = read_shard(content)
        slots += found[0].tolist()
        ids.append(found[1])
    assert slots == sorted(set(slots)) and len(slots) == rows.sequences.sum()
    words = word_tokenizer(PATH)
    expected = sorted(np.frombuffer(words.encode(t or ""), "<u4").tolist() for _, t in texts)
    # In the order of numbers, sequences of a partition follow each other: documents come back whole.
    flat = np.concatenate(ids)
    total = int((flat == END_ID).sum())
    assert total == len(texts) and rows.ids.sum() == sum(len(x) + 1 for x in expected)
    back = read_sequences(manifest, path)
    assert back.count() == len(slots) and back.agg({"n_ends": "sum"}).first()[0] == len(texts)


def test_empty(spark, docs):
    path, manifest = write_shards(docs(EDGES).limit(0), PATH)
    assert manifest.count() == 0 and read_sequences(manifest, path).count() == 0
