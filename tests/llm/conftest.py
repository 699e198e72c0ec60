import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

CLASH = "doc_id long, text string, lang string, source string, n_chars long, _key string, hash string, score string, label string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, a very long text, repeated rows, and columns with clashing names."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeiou") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    base = text(120)
    rows = [
        (1, base), (2, base), (2, base), (3, base + " tail end"), (4, None), (5, ""), (6, " \n\t "), (7, "one two"),
        (8, "one two"), (9, text(30_000)), (None, text(60)), (None, None), (10, "ONE TWO"), (11, text(80) + "\n" + base),
    ]
    return spark.createDataFrame([(i, t, "en", "src", None, "k", None, "s", None) for i, t in rows], CLASH)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
