import pytest

DATA = "/root/testdata/sf0.001"

LONG = "word " * 30_000 + "x" * 50_000


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows and copies, extra columns with clashing names."""
    rows = [
        (0, None, None, None, None, "a", 1), (1, "", "en", "s0", 0, "b", 2), (2, LONG, "en", "s0", len(LONG), None, None), (3, "mail me: a.b@c.example.com or +1 (212) 555-0100", "en", "s1", 9, "c", 3),
        (3, "mail me: a.b@c.example.com or +1 (212) 555-0100", "en", "s1", 9, "c", 3), (4, "same text here", "de", None, 1, "d", 4), (5, "same text here", "de", "", 1, "d", 4), (6, "Same  TEXT here ", "de", "", 1, "d", 4),
        (7, "under the MIT license, apache license version 2; cc-by-nc", "en", "s1", 1, "e", 5), (8, "é" * 10 + " \U0001f600 ok", "fr", "s2", 1, "f", 6), (None, "no id at all", None, "s2", 1, "g", 7),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, label string, size long")


@pytest.fixture(scope="session")
def empty(spark, odd):
    return spark.createDataFrame([], odd.schema)
