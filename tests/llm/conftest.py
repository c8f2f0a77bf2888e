import pytest

from daymark.llm.catalog import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def docs(spark):
    """make([(id, text)]): documents with columns whose names clash with those of the operators."""

    def make(rows):
        full = [(i, t, "x", 1, "y", "z", True) for i, t in rows]
        kinds = "doc_id bigint, text string, runs string, n bigint, verdict string, mask string, kept boolean"
        return spark.createDataFrame(full, kinds)

    return make


#: Null and empty texts, one word, repeated rows, a null id.
EDGES = [(1, None), (2, ""), (3, "word"), (4, " \n\t "), (5, "same text here"), (5, "same text here"), (None, "no id at all"), (6, "é" * 30)]
