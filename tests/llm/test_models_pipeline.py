"""Operators 4 and 8 by held-out accuracy, the pipeline against brute force, registration."""

from __future__ import annotations

import numpy as np
import pytest
from helpers import clashing, prose
from pyspark.sql import functions as F

from sluice.llm import language_id, quality

WORDS = {"en": "the of and to in is that for with this are was", "de": "der die und das ist nicht ein von mit sich auf für",
         "fr": "le la les et des est une dans pour que qui sur", "es": "el los y de que en una por con para las del", "xx": "qo zu wuk jax kij vex"}


def labelled_docs(rng, langs, n=40):
    rows = []
    for lang in langs:
        for _ in range(n):
            rows.append((len(rows), " ".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randrange(5, 60))).title(), lang))
    return rows


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def test_languages_of_held_out_texts(make_docs, rng):
    rows = labelled_docs(rng, ("en", "de", "fr", "es", "xx"))
    extra = [(900, None, "en"), (901, "", None), (902, "12 34 !!", "de"), (903, "der und nicht sich", None), (None, "los que para las", None),
             (904, "the of and " * 50000, None), (904, "the of and", None)]
    got = [tuple(r) for r in language_id.identify(clashing(make_docs(rows + extra)).drop("score"), held_out()).collect()]
    assert len(got) == len(rows) + len(extra)
    truth = {i: lang for i, _, lang in rows}
    tested = [(truth[d], lang) for d, out, lang, _ in got if d in truth and out]
    assert len(tested) > 30 and sum(a == b for a, b in tested) >= 0.97 * len(tested)
    by = {d: (lang, score) for d, _, lang, score in got}
    assert by[900] == by[901] == by[902] == ("und", 0.0)
    assert by[903][0] == "de" and by[None][0] == "es" and by[904][0] == "en"
    assert all(0 <= s <= 1 for _, _, _, s in got)


def test_copies_of_labelled_rows_do_not_grow_the_sample(make_docs, rng, monkeypatch):
    seen = []

    class Watched(language_id.Stored):
        def __init__(self, df, name):
            super().__init__(df, name)
            seen.append((name, self.df.count()))
    monkeypatch.setattr(language_id, "Stored", Watched)
    rows = labelled_docs(rng, ("en", "de"), 12)
    copies = make_docs(rows + [rows[0]] * 300)
    language_id.fit(copies, per_language=10)
    assert seen == [("language-sample", 20)]


def test_one_language_or_none(make_docs):
    one = language_id.identify(make_docs([(0, "a b", "en"), (2, "c", None)]), F.lit(False)).collect()
    assert {(r["lang_pred"], r["score"]) for r in one} == {("en", 1.0)}
    none = language_id.identify(make_docs([(0, "a b", None)]), F.lit(False)).collect()
    assert [tuple(r) for r in none] == [(0, False, "und", 0.0)]
    assert language_id.identify(make_docs([]), F.lit(False)).collect() == []


def test_a_text_has_the_same_grams_alone_and_in_a_batch(rng):
    texts = ["", "Ab c", "x", prose(rng, 20), "é.ß"]
    ids, owner, letters = language_id.gram_ids(texts)
    for i, t in enumerate(texts):
        own, _, n = language_id.gram_ids([t])
        assert (ids[owner == i] == own).all() and letters[i] == n[0] == sum(map(str.isalpha, t))


LABELS = "doc_id long, quality int, toxic int"


def quality_rows(rng, n=200):
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.6
        text = prose(rng, rng.randrange(20, 300)) + "." if good else rng.choice([" ".join(["spam"] * rng.randrange(20, 300)), prose(rng, rng.randrange(20, 300)).upper().replace(" ", "!! ")])
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality_of_held_out_texts(spark, make_docs, rng):
    rows, labels = quality_rows(rng)
    extra = [(5000, None), (5001, ""), (None, "x"), (5002, prose(rng, 20000) + "."), (5002, prose(rng, 30) + ".")]
    docs = clashing(make_docs(rows + extra)).drop("score")
    frame = spark.createDataFrame(labels + [(7, None, 1), (None, 1, 0), (5000, 9, 0), (3, labels[3][1], 0)], LABELS)
    got = quality.classify(docs, frame).collect()
    assert len(got) == len(rows) + len(extra)
    truth = dict((d, q) for d, q, _ in labels)
    tested = [(truth[r["doc_id"]], r["predicted"]) for r in got if r["doc_id"] in truth and r["held_out"]]
    assert len(tested) > 20 and sum(a == b for a, b in tested) >= 0.95 * len(tested)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)


def test_few_kinds_of_labels(spark, make_docs):
    docs = make_docs([(0, "a"), (1, "b")])
    for labels, want in (([], 1), ([(0, 1, 0)], 1), ([(0, 0, 0)], 0)):
        got = quality.classify(docs, spark.createDataFrame(labels, LABELS).where(F.lit(True))).collect()
        assert {r["predicted"] for r in got} == {want}
    assert quality.classify(make_docs([]), spark.createDataFrame([], LABELS)).collect() == []


def test_rules_are_the_paths_of_the_trees(spark):
    class Tree:
        toDebugString = ("x\n  If (feature 0 <= 0.5)\n   If (feature 1 <= 2.0)\n    Predict: 0.0\n   Else (feature 1 > 2.0)\n    Predict: 1.0\n"
                         "  Else (feature 0 > 0.5)\n   If (feature 0 <= 0.75)\n    Predict: 0.0\n   Else (feature 0 > 0.75)\n    Predict: 1.0\n")

    class Forest:
        trees = [Tree, Tree]
    rules = {r.conditions for r in quality.rules_of(Forest)}
    a, b = (0, False, 0.5), (0, True, 0.5)
    assert rules == {(a,), (a, (1, False, 2.0)), (a, (1, True, 2.0)), (b,), ((0, False, 0.75), b), ((0, True, 0.75),)}


def test_words_behind_three_marks_are_not_bare(rng):
    words = ['((("word', "***note", "--- ", "...", "a"]
    assert quality._word_statistics(" ".join(words))[4] == 2 / 5


def test_statistics_do_not_depend_on_the_batch(rng):
    texts = ["", "A b. C!\nd d", prose(rng, 30)]
    assert np.array_equal(quality.statistics(texts), np.vstack([quality.statistics([t]) for t in texts]))


# --- pipeline and registration ------------------------------------------------------------
def test_pipeline_equals_its_parts_by_brute_force(spark, make_docs, rng, tmp_path):
    import corpus_pipeline
    import public_tokenizers
    from test_dedup import brute_dedup, brute_links
    from tokenizers import Tokenizer
    rows, labels = quality_rows(rng, 200)
    labelled = len(rows)
    item, passage = prose(rng, 30), prose(rng, 30)
    rows += [(400 + i, f"{prose(rng, 40)} {passage} {prose(rng, 40)}.") for i in range(4)]
    rows += [(500, prose(rng, 30) + " " + item + "."), (501, rows[labelled + 1][1]), (502, rows[labelled + 1][1] + " more"), (502, rows[labelled + 1][1] + " more")]
    for name, frame in (("documents", make_docs(rows)), ("labels", spark.createDataFrame(labels, LABELS)),
                        ("benchmark", spark.createDataFrame([(1, item)], "item_id long, text string"))):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/after_{name}.parquet")
        docs = spark.read.parquet(f"{tmp_path}/after_{name}.parquet")
        kept.append(sorted((r["doc_id"], r["text"]) for r in docs.collect()))
    good, single, cut, clean = kept
    bad = {d for d, q, _ in labels if not q}
    assert {d for d, _ in good} == {d for d, _ in rows} - bad
    assert single == sorted({(d, t) for (d, t) in good} & {(g, dict(good)[g]) for _, _, g in brute_links(good)})
    want = {d: k for d, _, _, k in brute_dedup(single, 20)}
    import hashlib
    assert {d: hashlib.sha256(b" ".join(t.encode().split())).hexdigest() for d, t in cut} == want
    assert {d for d, _ in cut} - {d for d, _ in clean} == {500}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert sum(r["length"] for r in pieces) == sum(len(tokenizer.encode(t).ids) + 1 for _, t in clean)


def test_clean_documents_of_a_contaminated_id_stay(spark, make_docs, rng, tmp_path):
    import corpus_pipeline
    item, clean = prose(rng, 30), [prose(rng, 40) for _ in range(4)]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, clean[0]), (None, item + " end"), (None, None), (7, clean[1]), (7, "so " + item), (8, clean[2]), (9, item), (9, item)]
    got = corpus_pipeline.benchmark_filter(spark, make_docs(rows), str(tmp_path)).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, clean[0]), (None, None), (7, clean[1]), (8, clean[2])], key=str)


def test_texts_of_one_id_with_one_32_bit_hash_stay_apart(spark, make_docs, tmp_path):
    import hashlib

    import corpus_pipeline

    from sluice.llm import jaccard_join, substring_dedup
    a, b = (" ".join(hashlib.md5(f"{i}-{j}".encode()).hexdigest() for j in range(25)) for i in (81084, 94972))
    both = make_docs([(None, a), (None, b)])
    assert both.select(F.hash("text")).distinct().count() == 1
    assert corpus_pipeline.near_duplicate_filter(spark, both, "").count() == 2
    spark.createDataFrame([(1, a)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [r["text"] for r in corpus_pipeline.benchmark_filter(spark, both, str(tmp_path)).collect()] == [b]
    docs = make_docs([(1, a), (5, a), (5, b)])
    assert sorted(r["n_removed"] for r in substring_dedup.dedup_substrings(docs).collect()) == [0, 0, 25]
    assert sorted(r["text"] for r in corpus_pipeline.repeat_filter(spark, docs, "").collect()) == sorted(["", a, b])
    assert sorted(tuple(r) for r in jaccard_join.join_similar(docs).select("did", "n_links").collect()) == [(1, 1), (5, 0), (5, 1)]


def test_every_operator_is_registered_once():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert set(entry.oracle_sql()) <= names


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op3_topk", "op6_url_filter", "op10_chat", "op12_lexical_search"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from sluice.llm.queries import ORACLES, QUERIES
    path = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet'")
    want = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, path).toPandas()[list(want.columns)]
    assert sorted(map(str, got.astype(object).where(got.notna(), None).itertuples(index=False, name=None))) == \
        sorted(map(str, want.astype(object).where(want.notna(), None).itertuples(index=False, name=None)))
