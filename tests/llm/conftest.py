import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
# Names that operators use inside; a caller's columns may be called the same.
CLASHES = ("row", "host", "owner", "repo", "digest", "a", "b", "n", "bucket", "body", "entries", "words", "spans", "found", "h", "part", "score")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, with clashing columns."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", len(r[1] or "")) for r in rows]
        docs = spark.createDataFrame(full, SCHEMA).repartition(3)
        for name in CLASHES:
            docs = docs.selectExpr("*", f"'other' AS {name}")
        return docs

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, a very long one, ties and repeated rows."""
    sentence = "the quick brown fox jumps over the lazy dog and then sleeps under a tree "
    long = "".join(f"word{i} " for i in range(60_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, sentence * 5), (5, sentence * 5),
        (None, sentence * 5), (None, "null id"), (6, long), (7, long + "tail"), (8, "Ünï¢ode 日本語 🙂 x"),
        (9, "\x00 nul"), (4, "other text of the same number"),
    ]
