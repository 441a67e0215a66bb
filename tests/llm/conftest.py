import pytest
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing names."""
    long = " ".join(f"word{i % 997}x{i}" for i in range(30_000))
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \n\t ", "en", "a", 4),
        (None, "a text without an id " * 20, "en", None, 1),
        (None, "a text without an id " * 20, "en", None, 1),
        (5, "same words again and again " * 30, "en", "a", 1),
        (5, "same words again and again " * 30, "en", "a", 1),
        (6, "same words again and again " * 30, "en", "b", 1),
        (7, long, "en", "b", 1),
        (8, "Zürich, ñandú — 東京 🎉 mail a.b@c.de +1 (505) 555-0351 and 505-555-0351", "de", "b", 1),
    ]
    clash = ("spans", "found", "kinds", "key", "root", "features", "score", "verdict", "print", "todo", "item_id", "id", "start", "q_")
    docs = spark.createDataFrame(rows, DOCS)
    return docs.select("*", *(F.lit("x").alias(c) for c in clash))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)
