import random

import pytest

WORDS = "amber birch cedar delta ember flint grove heath inlet joker kiosk lemon maple night ocean".split()


@pytest.fixture
def table(spark):
    """Documents from (doc_id, text), with columns whose names clash with the operators' own."""

    def make(rows, source=None):
        schema = "doc_id long, text string, source string, n int, id string, h string, key string, score double, spans string"
        full = [(i, t, source(i) if source else "s", 7, "own", "own", "own", 0.5, "own") for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def odd():
    """Null and empty texts, null ids, repeated rows, ties, spaces, and a very long text."""
    return [
        (1, None),
        (2, ""),
        (3, "   \n\t "),
        (4, "one"),
        (5, "Été À 東京 🙂 ÉTÉ  x y"),
        (6, "amber birch cedar delta ember flint grove"),
        (6, "amber birch cedar delta ember flint grove"),
        (7, "amber birch cedar delta ember flint grove"),
        (None, "amber birch cedar delta"),
        (None, None),
        (8, prose(30_000, 5)),
    ]


def prose(n, seed):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(400)) for _ in range(n))


@pytest.fixture(scope="session")
def make_prose():
    return prose
