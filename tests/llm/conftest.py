from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from {doc_id: text} or a list of (doc_id, text[, source])."""

    def make(rows):
        rows = list(rows.items()) if isinstance(rows, dict) else rows
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(600)]


@pytest.fixture(scope="session")
def near_texts(words):
    """Originals with copies of one to four changed words, and chains of copies."""
    rng = random.Random(6)
    out = {}
    for k in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([8, 25, 60, 200]))]
        for c in range(6):
            text = list(base)
            for _ in range(c):
                text[rng.randrange(len(text))] = rng.choice(words)
            out[100 * k + (37 * c) % 11] = " ".join(text)
            if c % 2:
                base = text
    return out
