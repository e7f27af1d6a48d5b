import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text[, source]) rows."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def odd_documents(documents):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns whose names operators use themselves."""
    long = " ".join(f"word{i % 977} and{i}" for i in range(30_000))
    rows = [
        (None, None), (None, None), (None, "a b c"), (1, ""), (2, " \t\n"), (3, "one two three four five six seven eight nine ten eleven"),
        (3, "one two three four five six seven eight nine ten eleven"), (4, "one two three four five six seven eight nine ten eleven"),
        (5, long), (6, long + " end"), (7, "ünï ©ödé 漢字 \U0001f600 <|endoftext|> x"), (8, "x" * 5000), (9, "x" * 5000), (10, "a\n\nA \nb\n"),
    ]
    df = documents(rows)
    extra = ["row", "key", "name", "node", "label", "rank", "class", "hash", "kept", "ids", "length", "start", "k1", "_key", "_row", "blob", "n_lines"]
    return df.selectExpr("*", *[f"'clash' AS {c}" for c in extra])
