"""Awkward rows that every operator and stage must take."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the quick brown fox jumps over the lazy dog and runs to the hills " * 4000


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "s", 1),
        (2, "alpha beta gamma delta epsilon zeta eta theta", None, None, None),
        (2, "alpha beta gamma delta epsilon zeta eta theta", None, None, None),
        (3, None, "en", "s", 0),
        (4, "", "en", "s", 0),
        (5, " \t\n ", "de", "s", 4),
        (6, "12345 !!! ###", "de", "s", 13),
        (7, LONG, "en", "s", len(LONG)),
        (8, LONG + "x", "en", "s", len(LONG) + 1),
        (9, "one", "fr", "s", 3),
        (None, "one", "fr", "s", 3),
        (None, None, None, None, None),
        (10, "café ▁ \U0001f389 naïve\r\nline", "fr", "s", 20),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def clashing(awkward):
    """The same rows with columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = "id h t sha src mark fp _id _mark _n block keep_id component_id kept first w m0".split()
    return awkward.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
