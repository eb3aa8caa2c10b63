import datetime as dt

from support import rows
from pyspark.sql import functions as F

from sluice.operators import evals as E
from sluice.operators import rules as RL
from sluice.operators import usage as U
from sluice.operators.promotion import DEFAULT_ML_RULES

DOC = """# Intro line
### [ML-01] Config and test move together
- **Severity:** BLOCKER
- **Citation:** Handbook › ML › ML-01

A hyperparameter change needs a new threshold.
❌ bad example
✅ good example
- sub bullet

### [ML-02] Aliases
Body of rule two.
"""


def _docs(spark, texts):
    return spark.createDataFrame([(i, "ml-model-lifecycle", t) for i, t in enumerate(texts)],
                                 "doc_id int, category string, block string")


def test_parse_rules_fields_and_defaults(spark):
    out = {r.rule_id: r for r in RL.parse_rules(_docs(spark, [DOC])).collect()}
    assert set(out) == {"ML-01", "ML-02"}
    assert out["ML-01"].severity_hint == "BLOCKER" and out["ML-01"].citation == "Handbook › ML › ML-01"
    assert out["ML-01"].content.startswith("Config and test move together\n\nA hyperparameter change")
    assert "- **Severity:**" not in out["ML-01"].content
    assert out["ML-02"].severity_hint == "SUGGESTION"
    assert out["ML-02"].citation == "Handbook › ml-model-lifecycle › ML-02"


def test_compact_rules_and_default_text(spark):
    docs = _docs(spark, [DOC, "no headings here", ""])
    compact = RL.compact_rules(docs)
    lines = {r.rule_id: r.rule_line for r in compact.collect()}
    assert lines["ML-01"] == ("- ML-01 [BLOCKER] (Citation: Handbook › ML › ML-01): "
                              "A hyperparameter change needs a new threshold.")
    assert lines["ML-02"].startswith("- ML-02 [SUGGESTION] (Citation: Handbook › ML Model Lifecycle › ML-02)")
    text = {r.doc_id: (r.n_rules, r.rules_text) for r in RL.rules_text(docs, DEFAULT_ML_RULES).collect()}
    assert text[0][0] == 2 and text[1] == (0, DEFAULT_ML_RULES) and text[2] == (0, DEFAULT_ML_RULES)


def test_a_heading_without_title_is_no_rule_and_bodies_are_whole(spark):
    docs = _docs(spark, ["### [AB-1]\nnot a rule\n### [AB-2]  Titled\n" + "word " * 200])
    assert [r.rule_id for r in RL.parse_rules(docs).collect()] == ["AB-2"]
    assert [r.rule_line for r in RL.compact_rules(docs).collect()] == ["- AB-2 [SUGGESTION] (Citation: Handbook › ML Model Lifecycle › AB-2): " + ("word " * 200).strip()]
    assert RL.compact_rules(docs, body_limit=9).first().rule_line.endswith("word word")


def test_top_k_ranks_exact_cosines_and_skips_zero_vectors(spark):
    emb = spark.createDataFrame([(5, [1.0, 0.0001]), (9, [1.0, 0.0]), (3, [0.0, 0.0])], "vec_id int, embedding array<float>")
    q = spark.createDataFrame([(0, [2.0, 0.0]), (1, [0.0, 0.0])], "vec_id int, embedding array<float>")
    for limit in (1, 1 << 20):
        assert rows(RL.vector_top_k(emb, q, k=1, exclude_self=False, query_limit=limit), "query_id", "match_id", "score") == [(0, 9, 1.0)]


def test_vector_top_k_equals_brute_force_with_copies_and_odd_vectors(spark):
    """Many copies of one vector, other lengths, nulls and non-finite entries; one row a batch or all at once."""
    import math
    import random
    rng = random.Random(2)
    data = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(150)] + [(200 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(90)]
    data += [(300 + i, [2.0 ** (i % 9), 2.0 ** (1 + i % 9), 3 * 2.0 ** (i % 9), 2.0 ** (2 + i % 9)]) for i in range(40)]  # the same direction
    data += [(400, None), (401, [1.0, None, 0.0, 0.0]), (402, [float("nan")] * 4), (403, [float("inf")] * 4), (404, [1.0, 2.0]), (405, []), (406, [0.0] * 4), (407, [1e300] * 4)]
    usable = [(i, v) for i, v in data if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]

    def cosine(a, b):
        dot = lambda x, y: sum(p * q for p, q in zip(x, y))
        m, n = max(map(abs, a)), max(map(abs, b))
        a, b = [x / m for x in a], [x / n for x in b]
        return dot(a, b) / (math.sqrt(dot(a, a)) * math.sqrt(dot(b, b)))

    emb = spark.createDataFrame([d for d in data if d[0] != 407], "vec_id long, embedding array<double>").repartition(3)
    want = []
    for q, a in usable:
        if q % 20 == 0:
            best = sorted((-round(cosine(a, b), 12), i) for i, b in usable if i not in (q, 407) and len(a) == len(b))[:5]
            want += [(q, n + 1, i) for n, (s, i) in enumerate(best)]
    for rows_per_batch in ("9", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_per_batch)
        got = RL.vector_top_k(emb, emb.where("vec_id % 20 = 0"), k=5)
        assert rows(got, "query_id", "rank", "match_id") == sorted(want)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def _vectors(keys, data):
    import pyarrow as pa
    return pa.table({keys: pa.array([i for i, _ in data], pa.int64()), "_qv" if keys == "query_id" else "_v": pa.array([v for _, v in data], pa.list_(pa.float64()))})


def test_vector_search_of_many_queries_holds_tiles(spark):
    """A task's memory goes with the queries' vectors and a tile, not with rows times queries."""
    import tracemalloc

    import numpy as np
    rng = np.random.default_rng(3)
    corpus = [(i, v) for i, v in enumerate(rng.normal(size=(9000, 4)).tolist())]
    search = RL._nearest(_vectors("query_id", corpus[:5000]), 3, False)
    batches = _vectors("match_id", corpus).combine_chunks().to_batches()
    tracemalloc.start()
    out = [b.to_pydict() for b in search(batches)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120e6  # the whole matrix has 360 MB
    x = np.array([v for _, v in corpus])
    cos = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for b in out:
        for q, m in zip(b["query_id"], b["match_id"]):
            got.setdefault(q, []).append(m)
    assert len(got) == 5000 and all(got[q] == np.argsort(-(cos @ cos[q]))[:3].tolist() for q in range(0, 5000, 250))


def test_vector_search_of_wide_vectors_holds_tiles(spark):
    """A tile has fewer rows where vectors are wide: a task's memory does not go with their length."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    x = np.random.default_rng(4).normal(size=(8000, 1024))
    vectors = pa.ListArray.from_arrays(np.arange(0, x.size + 1, 1024, dtype="int32"), x.ravel())
    queries = pa.table({"query_id": np.arange(0, 8000, 100), "_qv": vectors.take(pa.array(np.arange(0, 8000, 100)))})
    batches = [pa.RecordBatch.from_arrays([pa.array(np.arange(8000)), vectors], names=["match_id", "_v"])]
    tracemalloc.start()
    out = [b.to_pydict() for b in RL._nearest(queries, 3, True)(batches)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 130e6  # the whole batch has 66 MB, and several copies of it were held
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cos = unit[::100] @ unit.T
    cos[np.arange(80), np.arange(0, 8000, 100)] = -1
    got = {}
    for b in out:
        for q, m in zip(b["query_id"], b["match_id"]):
            got.setdefault(q, []).append(m)
    assert got == {q * 100: np.argsort(-cos[q])[:3].tolist() for q in range(80)}


def test_vector_neighbours_of_repeated_and_missing_keys(spark):
    """Copies of the query's own row and rows without a key among many copies of its vector."""
    data = [(20, [1.0, 2.0])] * 9 + [(i, [1.0, 2.0]) for i in range(100, 130)] + [(None, [1.0, 2.0])] * 2 + [(7, [2.0, 1.0])] * 3
    emb = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(2)
    got = RL.vector_top_k(emb, emb.where("vec_id = 20").limit(1), k=4)
    assert [(r["rank"], r.match_id, r.score) for r in got.orderBy("rank").collect()] == [(1, None, 1.0), (2, None, 1.0), (3, 100, 1.0), (4, 101, 1.0)]
    got = RL.vector_top_k(emb, emb.where("vec_id = 7"), k=4)
    assert [r.match_id for r in got.orderBy("rank").collect()] == [None] * 4  # three equal queries share the ranks of their id
    got = RL.vector_top_k(emb, emb.where("vec_id = 20").limit(1), k=4, exclude_self=False)
    assert [r.match_id for r in got.orderBy("rank").collect()] == [None, None, 20, 20]


def test_index_change_set(spark):
    schema = "rule_id string, title string, content string, citation string, category string, severity_hint string"
    old = spark.createDataFrame([("A-1", "t", "c", "x", "k", "S"), ("B-1", "t", "c", "x", "k", "S"),
                                 ("C-1", "t", "c", "x", "k", "S")], schema)
    new = spark.createDataFrame([("A-1", "t", "c", "x", "k", "S"), ("B-1", "t", "c2", "x", "k", "S"),
                                 ("D-1", "t", "c", "x", "k", "S")], schema)
    assert rows(RL.index_change_set(old, new), "rule_id", "op") == [("B-1", "update"), ("C-1", "delete"),
                                                                     ("D-1", "insert")]


def test_text_and_vector_top_k(spark):
    corpus = spark.createDataFrame([(1, "cross environment prod reference"), (2, "collect to the driver"),
                                    (3, "collect to the driver"), (4, "unrelated words")], "doc_id int, text string")
    q = spark.createDataFrame([(10, "driver collect"), (11, "prod reference")], "query_id int, text string")
    top = RL.text_top_k(corpus, q, k=2)
    assert rows(top, "query_id", "rank", "doc_id") == [(10, 1, 2), (10, 2, 3), (11, 1, 1)]
    emb = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [0.0, 1.0]), (3, [-1.0, 0.0])],
                                "vec_id int, embedding array<float>")
    vt = RL.vector_top_k(emb, emb.where("vec_id = 0"), k=2)
    assert rows(vt, "query_id", "rank", "match_id") == [(0, 1, 1), (0, 2, 2)]
    forced = RL.vector_top_k(emb, emb.where("vec_id = 0"), k=2, query_limit=1)
    assert rows(forced, "match_id", "score") == rows(vt, "match_id", "score")


PAYLOAD = ("request_id long, request_time timestamp_ntz, requester string, endpoint string, status_code int, "
           "execution_duration_ms long, request string, response string")


def test_usage_reports(spark):
    t = dt.datetime
    p = spark.createDataFrame([
        (1, t(2024, 2, 9, 10), "u1", "e", 200, 1500, "abcd", "efgh"),
        (2, t(2024, 2, 9, 11), "u1", "e", 200, 1000, "ab", "cd"),
        (3, t(2023, 12, 1), "u2", "e", 500, 9999, "x", "y"),  # outside the 30 days
    ], PAYLOAD)
    daily = U.usage_daily(p, dt.datetime(2024, 2, 10)).collect()
    assert [(r.day, r.pr_reviews, r.avg_secs, r.est_tokens) for r in daily] == [(dt.date(2024, 2, 9), 2, 1.3, 3)]
    total = U.usage_cost_total(U.usage_cost(U.usage_daily(p, dt.datetime(2024, 2, 10)))).first()
    assert total.total_reviews == 2 and total.total_usd == 0.0 and total.usd_per_review == 0.0
    empty = U.usage_cost_total(U.usage_cost(U.usage_daily(p.where("false"), dt.datetime(2024, 2, 10)))).first()
    assert (empty.total_reviews, empty.usd_per_review) == (0, 0.0)
    recent = U.recent_requests(p, 2).collect()
    assert [r.request_id for r in recent] == [2, 1] and recent[1].secs == 1.5
    br = U.rate_limit_breaches(p, endpoint_limit=1, user_limit=5).collect()
    assert br == []  # two calls by u1 sit in different minutes


def test_pii_screen(spark):
    df = spark.createDataFrame([(1, "mail me at a.b@example.org"), (2, "plain prose"),
                                (3, 'token = "24be64439e3e49cf46b2"'), (4, "host 10.0.0.12 ssn 123-45-6789")],
                               "doc_id int, text string")
    out = {r.doc_id: (r.flags, r.action) for r in U.pii_screen(df).collect()}
    assert out == {1: ("email", "BLOCK"), 2: ("", "ALLOW"), 3: ("secret", "BLOCK"), 4: ("ipv4,ssn", "BLOCK")}


def test_eval_scores_and_gate(spark):
    cases = spark.createDataFrame([(1, True, True, False), (2, False, False, True)],
                                  "case_id int, has_cross_env boolean, has_transform_issue boolean, is_clean boolean")
    good = spark.createDataFrame([(1, "ENV-01"), (1, "TP-02")], "case_id int, rule_id string")
    s = E.eval_scores(cases, good)
    assert all(all(r[1:]) for r in s.collect())
    assert {r.scorer: r.passed for r in E.eval_gate(s).collect()} == {k: True for k in E.SCORERS}
    bad = spark.createDataFrame([(1, "TP-02"), (2, "SQL-01")], "case_id int, rule_id string")
    gate = {r.scorer: r.passed for r in E.eval_gate(E.eval_scores(cases, bad)).collect()}
    assert gate == {"caught_cross_env_ref": False, "flagged_transform_violation": True,
                    "zero_false_positives_on_clean_code": False}
    no_cases = E.eval_gate(E.eval_scores(cases.where(F.lit(False)), bad))
    assert not any(r.passed for r in no_cases.collect())


def test_text_top_k_is_the_same_whatever_is_shipped(spark):
    words = ["cross", "env", "prod", "collect", "driver", "select", "table", "the", "a", "of"]
    corpus = spark.createDataFrame([(i, " ".join(words[(i * j) % 10] for j in range(1, 12))) for i in range(60)],
                                   "doc_id int, text string")
    q = spark.createDataFrame([(1, "prod env the"), (2, "collect driver"), (3, "select table of a")],
                              "query_id int, text string")
    broadcast = rows(RL.text_top_k(corpus, q, k=3))
    joined = rows(RL.text_top_k(corpus, q, k=3, broadcast_limit=0))
    queries_only = rows(RL.text_top_k(corpus, q, k=3, broadcast_limit=500))
    assert broadcast == joined == queries_only and len(broadcast) == 9
