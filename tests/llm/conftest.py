from __future__ import annotations

import pytest
from pyspark.sql import functions as F

CLASHES = ("size", "bucket", "record", "fp", "candidates", "spans", "score", "copy", "words", "salt", "ids", "row")


ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it at once", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog and runs away from it at once", "en", "a"),
    (2, "the QUICK brown fox jumps over the lazy dog and runs away from it at once", "en", "b"),
    (3, None, None, None),
    (None, "no id here but some words follow anyway in this text", "en", "a"),
    (4, "", "en", "b"),
    (5, " \t\n\r ", "de", None),
    (6, "word", "en", "a"),
    (7, "12345 67890 !!", None, "b"),
    (8, "der schnelle braune Fuchs springt über den faulen Hund und läuft weg", "de", "c"),
    (9, " ".join(f"long{i % 700}" for i in range(30_000)), "en", "a"),
    (10, "x" * 60_000, "en", "c"),
    (11, "mail me at joe.doe@example.com or +1 (234) 567-8901, card 4111 1111 1111 1111, host 10.0.0.1", "en", "a"),
    (12, "a\nb c\n\na\nb c\nb c ", "en", "b"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ids, and columns with clashing names."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    return docs.withColumns({name: F.lit(name) for name in CLASHES})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
