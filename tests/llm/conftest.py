import random

import pytest

#: Other columns, with names that operators use inside.
CLASHES = "p int, fp long, rest string, size long, bucket int, _id long, _text string, at double"


@pytest.fixture
def make_docs(spark):
    """Documents (doc_id, text, source) with columns whose names clash with inner ones."""

    def make(rows):
        full = [(*r, "src", 1, 2, "r", 3, 4, 5, "t", 0.5)[: 2 + 9] if len(r) == 2 else (*r, 1, 2, "r", 3, 4, 5, "t", 0.5) for r in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, source string, {CLASHES}")

    return make


@pytest.fixture
def prose():
    rng = random.Random(7)
    words = [a + b + c for a in ("ka", "lo", "mi", "ten", "ra") for b in ("do", "ri", "su", "") for c in ("n", "st", "le", "a", "")]

    def make(n, rng=rng):
        return " ".join(rng.choice(words) for _ in range(n))

    return make
