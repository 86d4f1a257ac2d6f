from __future__ import annotations

import pytest

LONG = "word " * 30_000 + "x" * 5_000


@pytest.fixture(scope="session")
def edge_texts():
    """Texts that are null, empty, blank, one word, repeated, very long, or of odd characters."""
    return [None, "", " \n\t ", "one", "one", "a  b\n\nc", LONG, "naïve Øre 日本語 ½ 　 end", "of the and", "'re it's <|endoftext|> x"]


@pytest.fixture()
def edge_docs(spark, edge_texts):
    """The edge texts with ids (one null, one repeated row) and columns whose names operators use."""
    rows = [(i if i != 3 else None, t, "kept", -1, 0.5) for i, t in enumerate(edge_texts)] + [(4, "one", "kept", -1, 0.5)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_tokens long, SCORE double")


@pytest.fixture()
def no_docs(edge_docs):
    return edge_docs.limit(0)
