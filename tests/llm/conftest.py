from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, found int"
LONG = "word another. " * 3000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, columns that clash."""
    rows = [
        (1, None, "en", "a", 0, "x", 1), (2, "", None, "a", 0, None, None), (3, "  \n\t ", "en", None, 4, "x", 1),
        (4, LONG, "en", "a", None, "x", 1), (4, LONG, "en", "a", None, "x", 1), (5, LONG, "de", "b", 1, "y", 2),
        (None, "no id here at all", "en", "a", 1, "x", 1), (None, "another without id", "fr", "a", 1, "x", 1),
        (None, "another without id", "fr", "a", 1, "x", 1),
        (6, "Grüße, naïve café: 3.14!", "de", "a", 1, "x", 1), (7, "12345 #### 67", "en", "a", 1, "x", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
