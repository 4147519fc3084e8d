import pytest
from pyspark.sql import types as T

KINDS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # columns whose names clash with those that operators make
    T.StructField("kept", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("fp", T.StringType()),
    T.StructField("place", T.StringType()), T.StructField("score", T.StringType()),
])
LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(30_000))
SPECIAL = "x <|endoftext|> it's ÉÀ 123 日本 \U0001F600 á\x1cb c\tD\r\nE"


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        """A table of (doc_id, text[, lang]) with clashing columns, over several partitions."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None, "k", "d", "f", "p", "x") for r in rows]
        return spark.createDataFrame(full, KINDS).repartition(3)
    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, special characters."""
    return [
        (1, "The same text, twice over and more words here to fill a window of thirteen and on."), (2, None), (3, ""), (4, " \n\t "),
        (5, "the same text, twice over and more words here to fill a window of thirteen and on."), (6, LONG), (7, LONG + " end"),
        (8, SPECIAL), (9, "a"), (9, "a"), (9, "b"), (None, "a"), (None, None), (12, "word " * 500), (-13, "x" * 3000),
    ]
