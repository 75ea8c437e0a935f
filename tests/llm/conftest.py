import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "ner", "tu", "sol", "ar", "ben") for b in ("ra", "ne", "ti", "los", "mu", "den", "ix", "o")]


@pytest.fixture()
def rng():
    return random.Random(11)


@pytest.fixture()
def prose(rng):
    """A function that gives a text of n words, a few of them on a line."""

    def make(n, words=WORDS, per_line=12):
        picked = [rng.choice(words) + str(rng.randrange(40)) for _ in range(n)]
        return "\n".join(" ".join(picked[i : i + per_line]) for i in range(0, n, per_line))

    return make


@pytest.fixture()
def frame(spark):
    """Rows of (doc_id, text) as a table with other columns, whose names the operators use inside."""

    def make(rows):
        extra = "key string, id string, found string, place string, words string, core string, bands string, hub string, component string"
        names = [c.split()[0] for c in extra.split(", ")]
        return spark.createDataFrame([(*r, *names) for r in rows], f"doc_id long, text string, {extra}")

    return make
