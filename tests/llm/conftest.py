import random

import pytest


def words(seed, n, size=400):
    """Random prose of n words."""
    rnd = random.Random(seed)
    parts = ["th", "er", "an", "on", "in", "re", "he", "ed", "nd", "ti", "es", "ou", "st"]
    stock = ["".join(rnd.choice(parts) for _ in range(1 + i % 4)) for i in range(size)]
    return " ".join(rnd.choice(stock) + rnd.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture
def prose():
    return words


@pytest.fixture
def awkward(spark):
    """Documents with nulls, empty and long texts, repeated rows and ids, and extra columns with awkward names."""
    long = words(1, 60_000)
    rows = [
        (1, "a b", "x", 1), (1, "a b", "x", 1), (2, None, None, None), (3, "", "y", 2), (None, "lost id", "z", 3),
        (None, None, None, 4), (4, " \n\t ", "w", 5), (5, long, "l", 6), (6, "é 漢字 😀", "u", 7), (6, "other text", "u", 8),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, fp int")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, score string, fp int")
