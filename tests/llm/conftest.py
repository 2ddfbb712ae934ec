import random

import pytest

VOICE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture(scope="session")
def prose():
    """prose(seed, words): text of made-up words, unlike for any two seeds."""
    def make(seed, words=120):
        r = random.Random(seed)
        return " ".join(r.choice(VOICE) + r.choice(VOICE)[:3] + str(r.randint(0, 9)) * (r.random() < 0.1) for _ in range(words))

    return make


@pytest.fixture(scope="session")
def documents(spark):
    """documents(rows): rows are (doc_id, text) or (doc_id, text, lang, source)."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make
