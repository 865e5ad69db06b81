from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source)."""

    def make(rows, schema=SCHEMA):
        full = [(r[0], r[1], "xx", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def prose():
    """Texts of n words from a seed."""

    def make(n, seed, vocabulary=400):
        rng = random.Random(seed)
        words = [f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{k % vocabulary:x}" for k in range(vocabulary)]
        return " ".join(rng.choice(words) + ("." if k % 9 == 8 else "") for k in range(n))

    return make


@pytest.fixture(scope="session")
def odd_rows(prose):
    """Nulls, empty, blank and very long texts, repeated rows, equal texts, odd characters."""
    long = prose(30_000, 5)
    return [
        (None, "a text without an id"),
        (1, None),
        (2, ""),
        (3, " \t\n\x0b\x0c\r"),
        (4, long),
        (5, long),
        (6, "one"),
        (7, "One"),
        (8, prose(60, 1)),
        (8, prose(60, 1)),
        (9, prose(60, 2), None),
        (10, " é  \U0001f600 n\x00l \x1c\x85 <|endoftext|>"),
        (11, prose(60, 1) + " more"),
    ]
