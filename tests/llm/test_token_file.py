"""Operator 11: Elias-Fano against the plain list, and round trips of whole tables through the files."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import clashing
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import token_file as T
from sluice.llm.common import table

PATH = public_tokenizers.path("word_bpe_49k.json")


def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1) | st.integers(0, 300), max_size=700))
def test_select_gives_the_numbers(values):
    values = sorted(values)
    ef = T.EliasFano.frombytes(T.EliasFano.build(values, values[-1] if values else 0).tobytes())
    assert [int(v) for v in ef.select(np.arange(len(values)))] == values
    assert [int(v) for v in ef.select(np.arange(len(values))[::-7])] == values[::-7]


def test_boundaries_take_near_minimal_space():
    rng = np.random.default_rng(3)
    ends = np.cumsum(rng.integers(1, 1000, 50_000))
    data = T.EliasFano.build(ends, int(ends[-1])).tobytes()
    per_number = 8 * len(data) / len(ends)
    assert per_number < 2.3 + np.log2(ends[-1] / len(ends))  # against 64 bits in a table of offsets


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80), st.text(alphabet=" \t\n\x0b\x1c\x1f\x85  Aa'stÉ́̈Σσς1٣ﬁ漢\U0001f600.,<|endoftext|>", max_size=60))
def test_words_give_the_ids_of_the_library(a, b):
    got = T.encoder(PATH, 2, T.token_bytes(PATH)).encode([a, b, a + " " + b])
    want = [e.ids + [2] for e in library().encode_batch([a, b, a + " " + b], add_special_tokens=False)]
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == want


def test_every_token_encodes_to_itself():
    """What makes merging by bytes and merging by pairs the same; without it words go through the library."""
    import copy
    import json
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    ranks = T.byte_ranks(spec)
    assert len(ranks) == 512 + len(spec["model"]["merges"])
    worse = copy.deepcopy(spec)  # one merge that its own parts never reach: a+bc, where ab comes first
    a, b = worse["model"]["merges"][0] if isinstance(worse["model"]["merges"][0], list) else worse["model"]["merges"][0].split(" ")
    worse["model"]["merges"].append([a, b + "q"])
    worse["model"]["vocab"][a + b + "q"] = 512 + len(spec["model"]["merges"])
    assert T.byte_ranks(worse) is None
    assert T.drops_space(spec)
    assert not T.drops_space({**spec, "normalizer": {"type": "NFKC"}})


def test_all_three_ways_give_the_same_ids():
    texts = [r["text"] for r in __import__("duckdb").sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet'").fetchdf().to_dict("records")]
    ways = [T.WordEncoder(PATH, 2, ranks).encode(texts) for ranks in (None, {}, T.token_bytes(PATH))]
    assert ways[0] == ways[1] == ways[2]


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(T, "PIECE", 50)
    monkeypatch.setattr(T, "CACHE_WORDS", 5)
    texts = ["word " * 100 + "x" * 300 + "\nnext\tline", "", "y" * 400, "漢字 " * 60]
    want = [e.ids + [2] for e in library().encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(g, "<u2").tolist() for g in T.encoder(PATH, 2, T.token_bytes(PATH)).encode(texts)] == want


def round_trip(spark, docs, path, **kw):
    """Checks the files of ``docs`` against the library; returns the read rows in file order."""
    T.write_tokens(docs, path, PATH, **kw)
    tok = library()
    want = sorted((-1 if d is None else d, d is not None, tuple(tok.encode(t or "", add_special_tokens=False).ids + [2]))
                  for d, t in ((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()))
    rows = sorted(T.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    got = [(-1 if r["doc_id"] is None else r["doc_id"], r["doc_id"] is not None, tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in rows]
    assert sorted(got) == want
    assert [r["doc_id"] for r in rows] == sorted([r["doc_id"] for r in rows], key=lambda d: (d is not None, d))  # ascending, null first
    assert [r["number"] for r in rows] == list(range(len(rows)))
    assert [r["start"] for r in rows] == np.cumsum([0] + [r["n_tokens"] for r in rows])[:-1].tolist()
    return rows


@pytest.mark.parametrize("size", [dict(), dict(segment_bytes=64), dict(segment_docs=2)])
def test_round_trip(spark, make_docs, tmp_path, size):
    docs = make_docs([(5, "The cat's hat."), (None, "no id"), (None, None), (-7, ""), (5, "The cat's hat."), (5, "another text of this id"),
                      (2 ** 62, "LARGE id  \t spaces"), (-(2 ** 63) + 1, "least id"), (3, None), (9, "word " * 3000), (4, "<|endoftext|> é 漢字")]).repartition(3)
    round_trip(spark, clashing(docs).withColumns({"place": docs.doc_id, "ids": docs.doc_id, "segment": docs.text}), str(tmp_path / "f"), **size)


def test_empty_table(spark, make_docs, tmp_path):
    assert round_trip(spark, make_docs([]), str(tmp_path / "f")) == []


def test_slice_of_documents(spark, make_docs, tmp_path):
    docs = make_docs([(i, f"text number {i} " * (i % 9)) for i in range(300)]).repartition(5)
    path = str(tmp_path / "f")
    T.write_tokens(docs, path, PATH, segment_docs=16)
    rows = {r["number"]: r for r in T.read_tokens(spark, path).collect()}
    for first, last in ((0, 1), (13, 170), (299, None), (300, None), (5, 5)):
        part = T.read_tokens(spark, path, first, last).collect()
        assert sorted(part, key=lambda r: r["number"]) == [rows[i] for i in range(first, min(300, 300 if last is None else last))]


def test_copies_of_one_row_are_spread(spark, make_docs):
    docs = make_docs([(None, "the same text")] * 400).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert T.segments(docs, PATH).select("shard").distinct().count() > 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_query_on_a_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    tok, start, want = library(), 0, []
    for r in table(spark, sf_dir, "documents").orderBy("doc_id").collect():
        ids = np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, T.query(spark, sf_dir).collect())) == want
