"""Operators 3, 5, 6, 9 and 10: exact results, round trips, edge rows."""

from __future__ import annotations

import math

import numpy as np
import public_tokenizers
import pytest
from helpers import clashing, prose
from pyspark.sql import functions as F

from sluice.llm import chat, packing, token_count, topk, url_filter

BPE = public_tokenizers.path("byte_bpe_50k.json")


# --- operator 3 -------------------------------------------------------------------------
def brute_top(rows, k, queries):
    vecs = {(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, a in sorted(vecs):
        if q in queries:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vecs if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.fixture
def vectors(spark, rng):
    rows = [(i, [rng.gauss(0, 1 + i % 3) for _ in range(6)]) for i in range(300)]
    rows += [(i, [0.5] * 6) for i in range(300, 340)] + [(340, [0.0] * 6), (341, None), (342, [1.0, None, 0, 0, 0, 0]), (343, [float("nan")] * 6),
                                                        (344, [float("inf")] + [0.0] * 5), (None, [9.0] * 6), (345, [3.0, 1.0]), (346, []), rows[0]]
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_top_k_equals_brute_force(vectors):
    rows, df = vectors
    queries = {0, 50, 100, 150, 300, 340, 345, 346}
    for settings in ({}, {"ring": 7, "block": 3, "pivots": 4}):
        got = topk.top_k(clashing(df), is_query=F.col("id").isin(*queries), **settings)
        assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 5, queries)


def test_top_k_of_few_or_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(1, [1.0]), (2, [2.0])], schema)
    assert sorted(tuple(r) for r in topk.top_k(few).collect()) == [(1, 1, 2, 256 * 512), (2, 1, 1, 256 * 512)]
    assert topk.top_k(spark.createDataFrame([(1, [1.0])], schema)).collect() == []
    assert topk.top_k(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("size", [1e4, 1e7, 1e12, 1e300])
def test_top_k_of_large_components(spark, rng, size):
    """Sums beyond 53 and 62 bits are exact; components beyond the limit count as it."""
    rows = [(i, [rng.uniform(-size, size) if rng.random() < 0.5 else rng.gauss(0, 1) for _ in range(3)]) for i in range(120)]
    x = {i: [max(-topk.LIMIT, min(topk.LIMIT, math.floor(256 * c))) for c in v] for i, v in rows}
    want = []
    for q in range(0, 120, 10):
        best = sorted((-sum(a * b for a, b in zip(x[q], v)), i) for i, v in x.items() if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), is_query=F.col("id") % 10 == 0, ring=9, block=4, pivots=5)
    assert sorted((r[0], r[1], r[2], int(r[3])) for r in got.collect()) == want


def test_top_k_of_an_id_with_two_vectors(spark):
    """Both are candidates, and what the id asks for is the best that either finds."""
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [5.0, 0.0]), (3, [0.0, 4.0]), (4, [3.0, 3.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=3)
    found = {(r[0], r[1]): (r[2], int(r[3]) // 65536) for r in got.collect()}
    assert [found[1, n] for n in (1, 2, 3)] == [(2, 5), (3, 4), (4, 3)]
    assert [found[4, n] for n in (1, 2, 3)] == [(2, 15), (3, 12), (1, 3)]


# --- operator 5 -------------------------------------------------------------------------
def test_differencing_deals_every_item_once(rng):
    for windows in (1, 2, 7):
        sizes = [rng.randrange(1, 300) for _ in range(60)]
        of, sums = packing.differencing(sizes, windows)
        assert sums.tolist() == [sum(s for s, w in zip(sizes, of) if w == k) for k in range(windows)] and sum(sums) == sum(sizes)
        assert sums.max() - sums.min() < 30
    of, sums = packing.differencing([8, 7, 6, 5, 4], 2)  # the textbook case: 16 and 14
    assert sorted(sums.tolist()) == [14, 16]


def test_windows_rise_until_none_exceeds_the_capacity():
    of, windows = packing.near_equal_windows([7, 7, 7], 10)
    assert windows == 3 and sorted(of.tolist()) == [0, 1, 2]


def test_packed_pieces_give_back_all_ids(make_docs, rng):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    texts = [prose(rng, rng.randrange(1, 900)) for _ in range(60)] + [
        None, "", " ", "  two  spaces ", "tab\tand\n new  line \n", " <|endoftext|> don't ", "ab\u00a0 c\u3000d \x1c e", "é漢字😀 " * 50, prose(rng, 30000), "x" * 9000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, texts[3])]
    got = packing.pack(clashing(make_docs(rows)), BPE, windows=8).toPandas()
    want = sorted((str(d), np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for d, t in rows)
    joined = {}
    for r in got.sort_values(["doc_id", "start"]).itertuples():
        key = "None" if r.doc_id != r.doc_id else str(int(r.doc_id))
        joined.setdefault(key, []).append((r.start, r.ids, r.length, r.doc_tokens))
    assert set(joined) == {d for d, _ in want}
    for d, ids in want:
        if d != "3":  # that row stands twice
            assert b"".join(x[1] for x in joined[d]) == ids
            assert [x[0] for x in joined[d]] == np.cumsum([0] + [x[2] for x in joined[d]])[:-1].tolist()
            assert {x[3] for x in joined[d]} == {len(ids) // 4}
    assert got["length"].sum() == sum(len(i) // 4 for _, i in want)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s["length"].sum() <= 2048 and s["offset"].tolist() == np.cumsum([0, *s["length"]])[:-1].tolist()
    assert len(got.groupby("sequence_id")) <= 1.05 * got["length"].sum() / 2048 + 10  # some partitions are small


def test_packing_an_empty_table(make_docs):
    assert packing.pack(make_docs([]), BPE).collect() == []


# --- operator 6 -------------------------------------------------------------------------
PAGES = "page_id long, url string, html string"


def test_urls_rules_and_hosts(spark):
    urls = {
        "https://A.Example.ORG/es/1": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12?x": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://example.org/en/2#y": ("example.org", "/en/2", "org/", "allow"),
        "http://notexample.org": ("notexample.org", "", None, "allow"),
        "http://myorg/": ("myorg", "/", None, "allow"),
        "ftp://b.com/de/x": ("b.com", "/de/x", "com/de/", "block"),
        "x://b.com/fr/?://z/": ("b.com", "/fr/", "com/fr/", "allow"),
        "no scheme": ("", "", None, "allow"),
        "http://?q": ("", "", None, "allow"),
    }
    rows = [(i, u, None) for i, u in enumerate(urls)] + [(99, None, "<a href='http://b.com/'>"), (None, "http://b.com/en/", "")]
    got = {r["page_id"]: tuple(r)[1:5] for r in url_filter.filter_urls(clashing(spark.createDataFrame(rows, PAGES)).drop("host")).collect()}
    for i, want in enumerate(urls.values()):
        assert got[i] == want
    assert got[99] == ("", "", None, "allow")
    assert got[None] == ("b.com", "/en/", None, "allow")  # as much trust as distrust


def test_mass_follows_and_leads_links(spark):
    rows = [(1, "http://good.org/", '<a href="http://friend.net/x"><A HREF=\'//Second.net\'>'), (2, "http://bad.com/de/", '<a href="/own">'),
            (3, "http://spam.net/", '<p><a class=z href="https://bad.com/q"></a>'), (4, "http://friend.net/", ""), (5, "http://far.net/", '<a href="http://spam.net">'),
            (6, "http://second.net/", '<a href="http://bad.com/">'), (6, "http://second.net/", '<a href="http://bad.com/">')]
    got = {r["page_id"]: r for r in url_filter.filter_urls(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[3]["verdict"] == "block" and got[3]["distrust"] > 0 and got[3]["trust"] == 0
    assert got[5]["verdict"] == "block" and got[5]["distrust"] < got[3]["distrust"]
    assert got[4]["verdict"] == "allow" and got[4]["trust"] > 0
    assert got[1]["rule"] == "org/" and got[2]["verdict"] == "block"


def converged(links, seeds, damping=0.85, rounds=250):
    """PageRank of (src, dst) links in doubles."""
    out = {}
    for a, _ in links:
        out[a] = out.get(a, 0) + 1
    mass = dict(seeds)
    for _ in range(rounds):
        new = {h: (1 - damping) * m for h, m in seeds.items()}
        for a, b in links:
            new[b] = new.get(b, 0) + damping * mass.get(a, 0) / out[a]
        mass = new
    return mass


def test_ranks_equal_a_plain_iteration(spark, rng):
    """A graph with hubs, dead ends, loops and repeated links: masses, and with them verdicts, by definition."""
    hosts = [f"h{i}.net" for i in range(40)] + ["a.org", "b.org", "c.com"]
    links = [(rng.choice(hosts), rng.choice(hosts[:5] + hosts)) for _ in range(200)] + [("h0.net", h) for h in hosts] * 2
    urls = {h: f"http://{h}/" + ("de/" if h == "c.com" else "x") for h in hosts}
    rows = [(i, urls[a], f'<a href="http://{b}/">') for i, (a, b) in enumerate(links)]
    rows += [(1000 + i, urls[h], None) for i, h in enumerate(hosts)]
    allowed = [r for r in rows if r[1].startswith(("http://a.org", "http://b.org"))]
    seeds = {h: sum(r[1] == urls[h] for r in allowed) / len(allowed) for h in ("a.org", "b.org")}
    trust, distrust = converged(links, seeds), converged([(b, a) for a, b in links], {"c.com": 1.0})
    got = url_filter.filter_urls(spark.createDataFrame(rows, PAGES).repartition(3)).collect()
    assert len(got) == len(rows) and {"allow", "block"} == {r["verdict"] for r in got if r["rule"] is None}
    for r in got:
        t, d = trust.get(r["host"], 0), distrust.get(r["host"], 0)
        assert abs(int(r["trust"]) / url_filter.UNIT - t) < 1e-8 and abs(int(r["distrust"]) / url_filter.UNIT - d) < 1e-8
        if r["rule"] is None and abs(d - t) > 1e-6:
            assert r["verdict"] == ("block" if d > t else "allow")


def test_mass_goes_as_far_as_links_lead_whatever_the_table_holds(spark):
    """A chain of 40 hosts and a hub with many links, beside one rule page or thousands of them."""
    chain = [(i, f"http://c{i}.net/", f'<a href="http://c{i + 1}.net/">') for i in range(40)] + [(40, "http://c40.net/", '<a href="http://bad.com/">')]
    hub = [(100, "http://hub.net/", "".join(f'<a href="http://t{i}.net/">' for i in range(3000)) + '<a href="http://bad.com/">')]
    for n in (1, 3000):
        seeds = [(1000 + i, f"http://s{i}.com/de/", None) for i in range(n - 1)] + [(999, "http://bad.com/de/", None)]
        got = {r["page_id"]: r for r in url_filter.filter_urls(spark.createDataFrame(chain + hub + seeds, PAGES)).collect()}
        reached = [got[i]["distrust"] for i in range(41)]
        assert all(a < b for a, b in zip(reached, reached[1:])) and reached[0] > 0
        assert got[100]["distrust"] > 0
    assert got[40]["verdict"] == "block"


def test_very_long_html_and_repeated_pages(spark):
    html = "<p>" + "text " * 200_000 + '<a href="http://bad.com/">'
    rows = [(1, "http://x.net/", html)] * 2 + [(2, "http://bad.com/de/", None)] * 3
    got = url_filter.filter_urls(spark.createDataFrame(rows, PAGES)).collect()
    assert len(got) == 5 and {r["verdict"] for r in got} == {"block"}


def test_no_seeds_no_pages(spark):
    assert url_filter.filter_urls(spark.createDataFrame([], PAGES)).collect() == []
    one = spark.createDataFrame([(1, "http://x.net/a", None)], PAGES)
    assert [tuple(r) for r in url_filter.filter_urls(one).collect()] == [(1, "x.net", "/a", None, "allow", 0, 0)]


def test_url_plan_has_no_python(spark):
    df = url_filter.filter_urls(spark.createDataFrame([(1, "http://x.net/a", None)], PAGES))
    assert "Python" not in df._jdf.queryExecution().toString()


# --- operator 9 -------------------------------------------------------------------------
def test_counts_equal_the_library(make_docs, rng):
    import sentencepiece
    from tokenizers import Tokenizer, models
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    unigram = Tokenizer(models.Unigram([(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())], 0, True))
    texts = ["".join(rng.choice("ab  \n\t\u2581éß漢😀xyz.,") for _ in range(rng.randrange(60))) for _ in range(200)]
    texts += ["The quick brown fox", "   ", "", None, "a" * 5000, prose(rng, 3000)]
    got = {r["doc_id"]: r["n_tokens"] for r in token_count.count_tokens(clashing(make_docs(list(enumerate(texts)))), path).collect()}
    for i, t in enumerate(texts):
        assert got[i] == (len(unigram.encode("\u2581" + t.replace(" ", "\u2581")).ids) if t else 0)


def test_ties_go_to_the_longest_last_piece():
    from tokenizers import Tokenizer, models
    pieces = [("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -1.0), ("ab", -2.0), ("ba", -1.5)]
    for byte_pieces in (False, True):
        vocab = [("<unk>", 0.0), *pieces] + ([(f"<0x{i:02X}>", 0.0) for i in range(256)] if byte_pieces else [])
        unigram = Tokenizer(models.Unigram(vocab, 0, byte_pieces))
        counter = token_count.Counter(pieces, -3.0, byte_pieces)
        for text in ("a" * 7, "abab", "baab", "aé漢b", "éé", "aabba" * 4, "漢"):
            assert counter.count(text)[0] == len(unigram.encode("\u2581" + text).ids), (byte_pieces, text)


def test_counting_an_empty_table(make_docs):
    assert token_count.count_tokens(make_docs([]), public_tokenizers.path("piece_bpe_32k.model")).collect() == []


# --- operator 10 ------------------------------------------------------------------------
CONVERSATIONS = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "\\", "<\\s>", "\\\\[INST]\\", "<<s>", "[[INST]]", " </s> ", "", "a\n<</SYS>>\n\n", "[ROLE x] y [/ROLE]", "é😀\n", PROBE_TEXT := "\ue000"]


def test_escapes_are_reversible(rng):
    t = chat.BracketTemplate()
    texts = NASTY + ["".join(rng.choice(["\\", "<", "s>", "/", "[", "INST]", "</s>", " ", "x"]) for _ in range(rng.randrange(15))) for _ in range(500)]
    for text in texts:
        assert t.unescape(t.escape(text)) == text
        assert not any(c in t.escape(text) for c in chat.CONTROLS)
    turns = [(rng.choice(["user", "assistant", "system", "tool]", "", "[ROLE "]), x) for x in texts[:60]]
    assert t.read(t.render(turns)) == turns


def test_spans_are_the_texts():
    t = chat.BracketTemplate()
    turns = [("user" if i % 2 else "assistant", x) for i, x in enumerate(NASTY)]
    out, spans, rewrites = chat.locate(t, turns)
    assert rewrites == [] and [t.unescape(out[a:b]) for a, b in spans] == NASTY


def test_templates_that_rewrite_history_are_detected():
    class Trims(chat.BracketTemplate):
        """Shortens all but the last text, as templates that drop earlier reasoning do."""
        def render(self, turns):
            return super().render([(r, x if i == len(turns) - 1 else x[:3]) for i, (r, x) in enumerate(turns)])

    class Closes(chat.BracketTemplate):
        """Ends every output with a mark: no rewrite."""
        def render(self, turns):
            return super().render(turns) + "<end>"
    turns = [("user", "question"), ("assistant", "answer one"), ("user", "more"), ("assistant", "answer two")]
    out, spans, rewrites = chat.locate(Trims(), turns)
    assert rewrites == [1, 2, 3] and out[slice(*spans[3])] == "answer two"
    out, spans, rewrites = chat.locate(Closes(), turns)
    assert rewrites == [] and [out[a:b] for a, b in spans] == [x for _, x in turns]


def test_conversations_round_trip(spark):
    import hashlib
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (2, None, None, None), (2, 0, "assistant", NASTY[0]), (None, 0, "user", "x"),
            (3, 0, "assistant", "long " * 50000)] + [(4, i, "assistant", x) for i, x in enumerate(NASTY)]
    df = clashing(spark.createDataFrame(rows, CONVERSATIONS))
    got = {r["conv_id"]: r for r in chat.digest(chat.format_conversations(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("user\na\nassistant\nb\nassistant\nb\n") and got[1]["loss_sha256"] == sha("bb") and got[1]["n_turns"] == 3
    assert got[2]["turns_sha256"] == sha("\n\nassistant\n" + NASTY[0] + "\n") and got[2]["loss_chars"] == len(NASTY[0])
    assert got[None]["loss_chars"] == 0 and got[None]["loss_sha256"] == sha("")
    assert got[3]["loss_chars"] == 250000 and got[4]["loss_sha256"] == sha("".join(NASTY))
    assert chat.digest(chat.format_conversations(spark.createDataFrame([], CONVERSATIONS))).collect() == []
