"""Small tables for the training-data operators."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def rng():
    return random.Random(11)


@pytest.fixture
def make_docs(spark):
    def make(rows):
        """(doc_id, text) pairs, or (doc_id, text, lang) triples."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make
