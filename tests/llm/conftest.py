from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and repeated rows, ties, one very long text, and extra columns with clashing names."""
    long_text = " ".join(f"w{i % 997}" for i in range(200_000))
    data = [
        (1, "Alpha beta gamma.\nSecond line, second LINE", "a", "x", "en", 1),
        (1, "Alpha beta gamma.\nSecond line, second LINE", "a", "x", "en", 1),
        (1, "another text under the same number", "a", "y", None, 2),
        (2, None, None, None, "en", None),
        (3, "", "b", "", None, 0),
        (None, "no number here", "b", "z", "fr", 3),
        (4, " \t\n ", "b", "z", "fr", 3),
        (5, "idiot", None, "z", "en", 3),
        (6, long_text, "c", "z", "en", 3),
        (7, "Éclair ÀÉ 日本語 \U0001f600 \x00 ok", "c", "z", "fr", 3),
    ]
    return spark.createDataFrame(data, "doc_id long, text string, source string, fp string, lang string, n_chars long").withColumnsRenamed(
        {"n_chars": "bucket"}
    )


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
