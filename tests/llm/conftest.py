import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Rows that every operator over documents must stand: nulls everywhere, empty and blank texts, repeats, no letters.
ODD_ROWS = [
    (None, None, None, None, None), (None, "a text without an id", None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0),
    (3, "   \n\t ", "en", None, 5), (4, "same words in two rows of one id", "en", "s", 1), (4, "same words in two rows of one id", "en", "s", 1),
    (5, "password = hunter22 and password: abc", "en", "s", 1), (6, "12345 67890 ... !!", None, "s", 1),
    (7, "日本語 \U0001f642 naïve ÉCOLE's don't we'll", "fr", "s", 1), (8, "a", "en", "s", 1), (9, "x" * 3000, "en", "s", 1),
    (10, "word " * 20000, "en", "s", 1), (-3, "same words in two rows of one id", "de", "s", 1),
]


@pytest.fixture
def odd_docs(spark):
    return spark.createDataFrame(ODD_ROWS, DOCS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def real_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture
def rng():
    return random.Random(5)
