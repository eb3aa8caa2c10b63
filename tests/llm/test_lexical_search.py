"""Operator 12 against scoring every document by the definition."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from helpers import clashing, prose

from sluice.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda c: c[0].lower(), t) for t in TERM.findall(text or "")]


def brute(items, docs, k=10):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for d, c in counted:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                        for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        out += [(item, rank + 1, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def run(spark, make_docs, items, docs, **kw):
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = L.search(asked, make_docs(docs).repartition(3), **kw)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("sizes", [dict(), dict(bucket=3), dict(bucket=8, run_entries=200), dict(k=2, bucket=5)])
def test_against_every_document(spark, make_docs, rng, sizes):
    docs = [(i, prose(rng, rng.choice([3, 20, 60]), 40)) for i in range(150)]
    docs += [(i, docs[i % 7][1]) for i in range(150, 260)]  # ties
    docs += [(None, docs[3][1]), (None, "Other, text"), (7, docs[5][1]), (7, docs[5][1]), (400, ""), (401, None), (402, " .,;")]
    items = [(i, prose(rng, 12, 60)) for i in range(12)]
    items += [(20, "w1 w1 w1 w2"), (21, None), (22, ""), (23, "nowhere"), (None, "w3 W4"), (24, docs[0][1]), (24, docs[0][1]), (25, docs[1][1])]
    assert run(spark, make_docs, items, docs, **sizes) == brute(items, docs, sizes.get("k", 10))


def test_terms_are_maximal_and_only_ascii_folds(spark, make_docs):
    docs = [(1, "ÉCOLE École x_y-Z9 q"), (2, "école x y z9 Q"), (3, "\x00ab\x7fcd`ef{gh"), (4, "漢字かな ß ẞ İ")]
    items = [(i, t) for i, t in enumerate(["École", "École x", "x y Z9", "AB cd EF gh", "漢字かな İ", "ss ß"])]
    assert run(spark, make_docs, items, docs) == brute(items, docs)
    for _, t in docs + items:
        assert L.count_terms(t) == Counter(x.encode() for x in terms(t))


def test_common_terms_and_a_long_text(spark, make_docs, rng, monkeypatch):
    monkeypatch.setattr(L, "PIECE", 64)
    docs = [(i, "the " * (1 + i % 5) + prose(rng, 8, 500)) for i in range(300)] + [(999, prose(rng, 20_000, 500))]
    items = [(1, "the"), (2, "the w1 w2 w3"), (3, docs[17][1])]
    assert run(spark, make_docs, items, docs, bucket=16) == brute(items, docs)


def test_vocabulary_beyond_the_bound_and_blocks_of_items(spark, make_docs, rng, monkeypatch):
    docs = [(i, prose(rng, 30, 80)) for i in range(80)] + [(None, prose(rng, 9, 80)), (3, prose(rng, 9, 80))]
    items = [(i, prose(rng, 10, 120)) for i in range(15)]
    monkeypatch.setattr(L, "BLOCK_ENTRIES", 25)
    want = brute(items, docs)
    assert run(spark, make_docs, items, docs) == want
    monkeypatch.setattr(L, "VOCABULARY_BYTES", 0)
    assert run(spark, make_docs, items, docs) == want


def test_empty_tables_and_extra_columns(spark, make_docs):
    assert run(spark, make_docs, [], [(1, "a b")]) == []
    assert run(spark, make_docs, [(1, "a")], []) == []
    assert run(spark, make_docs, [(1, None)], [(1, None)]) == []
    asked, docs = spark.createDataFrame([(1, "a b")], "item_id long, text string"), make_docs([(1, "a b c"), (2, "b"), (3, "d")])
    extra = [clashing(df).withColumns({c: df.text for c in ("id", "item", "n", "terms", "tfs", "term", "asked")}) for df in (asked, docs)]
    assert sorted(map(tuple, L.search(*extra).collect())) == brute([(1, "a b")], [(1, "a b c"), (2, "b"), (3, "d")])


def test_bounds_prune_but_lose_nothing(rng):
    """Survivors of a bucket hold every document that reaches a score, and fewer than all of them."""
    import pandas as pd
    docs = [(i, 40, rng.sample(range(200), 30), [rng.choice([1, 1, 1, 2, 9]) for _ in range(30)]) for i in range(200)]
    frame = pd.DataFrame(docs, columns=["id", "n", "tids", "tfs"])
    rows = pd.concat(L._buckets(200, 8000, 50, 1 << 20)(iter([frame])))
    assert rows["length"].is_monotonic_decreasing and rows["first"].tolist() == [True, False, False, False]
    kept = all_docs = 0
    for row in rows.itertuples(index=False):
        bucket = L.Bucket(row)
        for _ in range(20):
            picked = np.array(rng.sample(range(len(bucket.terms)), 8))
            weight = np.array([rng.randrange(1, 5000) for _ in picked])
            scores = bucket.scores(np.arange(len(bucket.ids)), picked, weight)
            least = int(np.sort(scores)[-5])
            survivors = bucket.survivors(picked, weight, row.length, least)
            assert set(np.flatnonzero(scores >= least)) <= set(survivors)
            kept, all_docs = kept + len(survivors), all_docs + len(scores)
    assert kept < all_docs / 2
