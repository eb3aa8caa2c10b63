"""Helpers of the tests of the training-data operators."""

from __future__ import annotations

import random


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def clashing(df):
    """The same rows with columns named like internal ones."""
    from pyspark.sql import functions as F
    names = ("did", "tv", "key", "seg", "start", "score", "rank", "row", "words", "ids", "cid", "h", "pivot", "stats", "spans", "turns", "host")
    return df.withColumns({c: F.lit(-1) for c in names if c not in df.columns})
