"""Inputs that the tests of this folder share."""

import random

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and
    columns whose names the operators use inside."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = text(90)
    long = "\n".join(text(40) for _ in range(600))
    rows = [(1, shared, "s"), (2, text(30) + "\n" + shared, None), (3, None, "s"), (4, "", "t"), (None, text(50), "s"),
            (None, None, None), (5, long, "t"), (6, "one", "s"), (6, "one", "s"), (7, " \n\t ", "u"),
            (8, shared, "s"), (9, "ein\x00zwei drei " + shared.upper(), "s"), (10, "x " * 3000, "t"),
            (11, long + "\n" + text(10), "t"), (11, "two rows, one id", "t")]
    rows = [(i, t, "en", s, len(t or ""), 1, 2, "h", "d", 3.0) for i, t, s in rows]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, _id long, size int, hash string, "
              "_d string, score double")
