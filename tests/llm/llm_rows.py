"""Fixtures of the training-data tests: document tables with the awkward rows that every operator must take."""

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                          T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table from (doc_id, text) pairs."""
    def make(pairs):
        return spark.createDataFrame([(i, t, "en", "here", None if t is None else len(t)) for i, t in pairs], DOCUMENTS)
    return make


@pytest.fixture(scope="session")
def awkward():
    """Null ids and texts, empty, blank and long texts, a repeated row, a doc_id on two texts."""
    words = " ".join(f"word{i}" for i in range(60))
    return [(1, words), (2, None), (3, ""), (4, " \n\t "), (None, words), (None, None), (5, words), (5, words), (6, "one two three"),
            (6, "four five six seven eight"), (7, "long " * 40000), (8, "x" * 100000), (9, "é" * 50 + " ñandú \x1c \x85 日本 🙂 <|endoftext|> end"),
            (10, "a b c d e\na b c d e\na b c d e")]
