from __future__ import annotations

import random

import pytest

PARTS = "ba do fi gu ha je ki lo mu na or pe qua ri so ta ul ve wi za".split()
WORDS = [a + b for a in PARTS for b in PARTS]


@pytest.fixture
def prose():
    """Seeded texts of made-up words."""

    def make(seed, n_words, vocabulary=WORDS):
        draw = random.Random(seed)
        return " ".join(draw.choice(vocabulary) for _ in range(n_words))

    return make


@pytest.fixture
def table(spark):
    """A documents-like table from (doc_id, text) or (doc_id, text, lang, source) rows, with clashing extra columns."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, n_words string, key string, fp string, row string"
        full = [(*r, *(None,) * (4 - len(r)), len(r[1] or ""), "clash", "clash", "clash", "clash") for r in rows]
        return spark.createDataFrame(full, schema)

    return make
