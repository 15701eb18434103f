"""Fixtures of small tables with odd rows."""

import pytest

SF_SMALL = "/root/testdata/sf0.001"
EDGE_TEXTS = [None, "", " \n\t ", "...", "a", "The same text of a few words.", "The same text of a few words.",
              "word " * 30_000, "x" * 20_000, "İ ΑΣ é́   \u0085 　 日本語 💩", "<|endoftext|> <|im_end|>", "1234 5678", "The same text of a few words!"]


@pytest.fixture()
def edge_docs(spark):
    """Null ids and texts, ties, repeated rows, long texts, and columns whose names clash with outputs."""
    rows = [(i if i != 3 else None, t, "en" if i % 2 else None, "s", 0, "clash", 1.0, True) for i, t in enumerate(EDGE_TEXTS)]
    rows += [rows[5], rows[5]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, score double, kept boolean")


@pytest.fixture()
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture()
def edge_labels(spark):
    return spark.createDataFrame([(i, 1 if i % 3 else 0, 1 if i == 5 else 0) for i in range(9)] + [(None, 1, 1), (4, None, None)],
                                 "doc_id long, quality int, toxic int")
