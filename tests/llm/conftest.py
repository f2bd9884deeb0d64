import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, rank int, score string, _id int, copies string"
CLASH = ("f", 7, "s", 9, "c")  # extra columns whose names the operators use themselves


@pytest.fixture(scope="session")
def words():
    """Invented words, the same on every run."""
    rng = random.Random(3)
    return ["".join(rng.choice("abdegiklmnoprstuv") for _ in range(rng.randint(2, 8))) for _ in range(3000)]


@pytest.fixture(scope="session")
def prose(words):
    rng = random.Random(5)
    return lambda n: " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text[, lang, source]) with clashing extra columns."""

    def build(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or ""), *CLASH) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return build
