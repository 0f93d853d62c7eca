"""Fixtures that the tests of this folder import by name."""

import random

import pytest

WORDS = ("the of and to in is was for on that by this with from are river stone light paper house garden "
         "winter summer quick brown fox jumps over lazy dog number seven eleven").split()


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators also use inside."""
    def make(rows, source=None):
        data = [(i, t, "en", source(i) if source else f"src{(i or 0) % 3}", None if t is None else len(t), 1.5, "x", 7)
                for i, t in rows]
        return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, "
                                           "score double, kept string, size long").repartition(3)
    return make


@pytest.fixture(scope="session")
def prose():
    def make(n, seed):
        r = random.Random(seed)
        return " ".join(r.choice(WORDS) + str(r.randint(0, 30)) for _ in range(n))
    return make


ODD = [(900, None), (901, ""), (902, "   \n\t "), (903, "one"), (904, "x" * 5000), (None, "text without an id")]


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, short and space-less texts, and a null id."""
    return list(ODD)
