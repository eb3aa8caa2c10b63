"""Block search against scoring every document, whichever side moves."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from support import rows

from sluice.operators import rules as RL
from sluice.operators import search as SE


def split():
    return F.split(F.lower(F.col("text")), RL.TOKEN_SPLIT)


def words(text):
    return [w for w in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()]


def brute(docs, queries, k):
    counted = [(d, Counter(words(t))) for d, t in docs]
    df = Counter(t for _, c in counted for t in c)
    out = []
    for q, text in queries:
        scored = []
        for d, c in counted:
            score = sum(c[t] * math.floor(math.log(len(docs) / df[t]) * 1e9 + 0.5) for t in set(words(text)) if t in c)
            if score > 0:
                scored.append((-score, d))
        out += [(q, i + 1, d, -s / 1e9) for i, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def make(spark, tmp_path, docs, queries, key="long"):
    spark.createDataFrame(docs, f"doc_id {key}, text string").repartition(4).write.parquet(str(tmp_path / "docs"))
    spark.createDataFrame(queries, "query_id long, text string").write.parquet(str(tmp_path / "queries"))
    return spark.read.parquet(str(tmp_path / "docs")), spark.read.parquet(str(tmp_path / "queries"))


def prose(rng, n):
    return " ".join(f"w{int(60 * rng.random() ** 3)}" for _ in range(n))


@pytest.fixture
def texts():
    rng = random.Random(4)
    docs = [(i, prose(rng, rng.choice([4, 30, 200]))) for i in range(200)] + [(300 + i, "Equal, equal w3 w1!") for i in range(5)]
    docs += [(400, None), (401, ""), (402, "w1 " * 500)]
    queries = [(i, prose(rng, 6)) for i in range(20)] + [(50, "equal"), (51, None), (52, "nowhere"), (53, "w1 w1 w0"), (54, ". ,")]
    return docs, queries


def test_either_side_moves_and_the_results_stay(spark, tmp_path, texts):
    docs, queries = texts
    corpus, asked = make(spark, tmp_path, docs, queries)
    want = brute(docs, queries, 3)
    for limit in (1 << 26, 1 << 14, 0):  # the corpus moves, the queries move, neither does
        assert rows(RL.text_top_k(corpus, asked, k=3, broadcast_limit=limit)) == want
    for size in (1, 7, 500):
        assert rows(SE.ranked(SE.search_with_queries(corpus, asked, 4, "doc_id", "query_id", split(), size, 300), 4, "query_id", "doc_id")) == brute(docs, queries, 4)
        assert rows(SE.ranked(SE.search_in_corpus(corpus, asked, 4, "doc_id", "query_id", split(), size), 4, "query_id", "doc_id")) == brute(docs, queries, 4)


def test_few_documents_are_scored(spark, tmp_path):
    """Rare terms in a few documents: blocks without them are passed over, and a task hands on k rows a query at most."""
    rng = random.Random(8)
    docs = [(i, prose(rng, 40) + (f" rare{i // 40}" if i % 40 == 0 else "")) for i in range(4000)]
    queries = [(q, f"w1 w2 w59 rare{q}") for q in range(30)]
    corpus, asked = make(spark, tmp_path, docs, queries)
    found = RL.text_search(corpus, asked, k=1, broadcast_limit=1 << 16)
    scored = {r.query_id: r.scored for r in SE.work(found).collect()}
    assert len(scored) == 30 and sum(scored.values()) < 30 * 4000 * 0.4
    assert found.count() <= 30 * 4 * 1
    assert rows(SE.ranked(found, 1, "query_id", "doc_id"), "query_id", "doc_id") == [(q, d) for q, _, d, _ in brute(docs, queries, 1)]


def test_string_keys_and_empty_sides(spark, tmp_path):
    docs, queries = [("b", "one two"), ("a", "one two"), ("c", "three")], [(1, "two three"), (2, "one")]
    corpus, asked = make(spark, tmp_path, docs, queries, "string")
    for limit in (1 << 26, 600, 0):
        assert rows(RL.text_top_k(corpus, asked, k=2, broadcast_limit=limit), "query_id", "rank", "doc_id") == [(1, 1, "c"), (1, 2, "a"), (2, 1, "a"), (2, 2, "b")]
        for a, b in ((corpus.limit(0), asked), (corpus, asked.limit(0))):
            assert RL.text_top_k(a, b, broadcast_limit=limit).count() == 0


def test_bounds_hold_every_score():
    rng = random.Random(1)
    doc, term = zip(*sorted({(rng.randrange(300), rng.randrange(40)) for _ in range(3000)}))
    doc, term, count = np.array(doc), np.array(term), np.array([rng.choice([1, 1, 2, 30]) for _ in doc])
    index = SE.BlockIndex(np.arange(300) * 3, doc, term, count, 40, 16)
    for _ in range(50):
        terms = np.array(sorted(rng.sample(range(40), 5)))
        weights = np.array([rng.randrange(1, 1000) for _ in terms])
        weight = dict(zip(terms.tolist(), weights.tolist()))
        scores = Counter()
        for d, t, c in zip(doc.tolist(), term.tolist(), count.tolist()):
            scores[3 * d] += weight.get(t, 0) * c
        want = sorted(((-s, d) for d, s in scores.items() if s > 0))[:4]
        got, places, scored = index.search(terms, weights, 4)
        assert [(-s, d) for s, d in zip(got.tolist(), index.keys[places].tolist())] == want
        assert scored <= 300


def test_tokens_are_looked_up_in_pieces():
    """What a task derives from a batch of token lists stays small beside the batch; rows stay whole, and none is lost."""
    import tracemalloc

    import pyarrow as pa
    tokens = [[f"t{(7 * i + j) % 9000}" for j in range(i % 1000)] if i % 50 else None for i in range(6000)] + [["t1"] * (SE.LOOKED_UP + 5), [], ["t2"]]
    batch = pa.record_batch({"key": pa.array(range(len(tokens)), pa.int64()), "tokens": pa.array(tokens, pa.list_(pa.string()))})
    vocabulary = pa.array([f"t{i}" for i in range(9000)])
    tracemalloc.start()
    run = SE._counted(vocabulary)([batch, batch.slice(0, 0)])
    counts, lists = 0, {}
    for piece in run:
        counts += sum(piece.column("counts").flatten().to_pylist())
        lists.update(dict.fromkeys(piece.column("key").to_pylist()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts == sum(len(t) for t in tokens if t) and sorted(lists) == [i for i, t in enumerate(tokens) if t]
    assert peak < 60e6  # the whole batch took over 100 MB


def test_bounds_of_pieces():
    import pyarrow as pa
    lengths = [0, SE.LOOKED_UP, 1, SE.LOOKED_UP + 1, 0, 3, SE.LOOKED_UP - 3, 1, 0]
    tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(["a"] * sum(lengths)))
    got = [pc.column("tokens").value_lengths().to_pylist() for pc in SE._pieces([pa.record_batch({"tokens": tokens})])]
    assert got == [lengths[:2], lengths[2:3], lengths[3:5][:1], lengths[4:7], lengths[7:]]
