"""Operators 1, 2 and 7 against brute force."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from helpers import clashing, prose

from sluice.llm import decontaminate, jaccard_join, substring_dedup
from sluice.llm.fm_index import FMIndex


# --- FM-index ---------------------------------------------------------------------------
@pytest.mark.parametrize("order", [3, 7, 20])
def test_matching_statistics_equal_a_scan(order):
    rng = np.random.default_rng(order)
    sequences = [rng.integers(1, 3, size=rng.integers(0, 50)).astype(np.uint64) for _ in range(20)]
    index = FMIndex(sequences, order)
    queries = [rng.integers(1, 4, size=rng.integers(0, 30)).astype(np.uint64) for _ in range(10)] + sequences[:4]
    lengths, rows, sizes = index.matching_statistics(queries)

    def places(p):
        return [(i, j) for i, x in enumerate(sequences) for j in range(len(x) - len(p) + 1) if (x[j:j + len(p)] == p).all()]

    at = 0
    for q in queries:
        for j in range(len(q)):
            want = max((n for n in range(1, min(order, len(q) - j) + 1) if places(q[j:j + n])), default=0)
            assert lengths[at] == want
            if want:
                assert sizes[at] == len(places(q[j:j + want]))
            if want == order:
                s, o = index.earliest(rows[at:at + 1])
                assert (s[0], o[0]) == min(places(q[j:j + want]))
            at += 1


# --- operator 1 -------------------------------------------------------------------------
def brute_dedup(rows, window):
    """(doc_id, n_words, n_removed, kept_sha256) of distinct ids, null first."""
    docs = sorted(((-1 << 63 if d is None else d), (t or "").encode().split()) for d, t in rows)
    first = {}
    for d, w in docs:
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i:i + window]), (d, i))
    out = []
    for d, w in docs:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (d, i):
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((None if d == -1 << 63 else d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run_dedup(df, **settings):
    from sluice.llm.common import public_id
    out = substring_dedup.dedup_substrings(df, **settings).select(public_id("did").alias("doc_id"), "n_words", "n_removed", "kept_sha256")
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.fixture
def repeated_docs(rng):
    passage = prose(rng, 60)
    rows = [(i, prose(rng, 50) + " " + passage[: rng.randrange(100, len(passage))] + "\n" + prose(rng, 30)) for i in range(10, 30)]
    rows += [(i, passage) for i in (40, 41, 42, 5)]
    rows += [(50, "la " * 300), (51, "la la " * 30), (52, ""), (53, None), (None, passage + " end"), (54, "one"), (55, "a b " * 25),
             (56, prose(rng, 5000, 40)), (57, rows[0][1].replace(" ", "\t \x0b"))]
    return rows


def test_removed_words_equal_brute_force(make_docs, repeated_docs):
    assert run_dedup(make_docs(repeated_docs)) == brute_dedup(repeated_docs, 20)


def test_hot_segments_and_small_shards_change_nothing(make_docs, repeated_docs):
    want = brute_dedup(repeated_docs, 20)
    assert run_dedup(make_docs(repeated_docs), hot_segments=1, shard_words=300) == want
    assert run_dedup(clashing(make_docs(repeated_docs)), seed=20) == want


def test_a_hot_passage_does_not_meet_in_one_group(make_docs, rng, tmp_path, monkeypatch):
    passage = prose(rng, 60, 3000)
    rows = [(i, f"{prose(rng, 40, 3000)} {passage} {prose(rng, 40, 3000)}") for i in range(80)] + [(7, prose(rng, 30)), (7, prose(rng, 30))]
    rows += [(81, prose(rng, 25) + " end")] * 30
    folder, search = str(tmp_path), substring_dedup._search_shard

    def counting(window):
        run = search(window)

        def counted(shard):
            import uuid
            from pathlib import Path
            Path(folder, uuid.uuid4().hex).write_text(str(shard.groupby("words").size().max()))
            return run(shard)
        return counted
    monkeypatch.setattr(substring_dedup, "_search_shard", counting)
    got = run_dedup(make_docs(rows), hot_segments=5, shard_words=2000)
    want = brute_dedup(rows[:80], 20)
    assert [r for r in got if r[0] < 80 and r[0] != 7] == [r for r in want if r[0] != 7]
    assert {r[2] for r in got if r[0] == 81} == {0}
    assert max([int(f.read_text()) for f in tmp_path.iterdir()], default=0) <= 5


def test_other_windows(make_docs, repeated_docs):
    assert run_dedup(make_docs(repeated_docs), window=7, seed=3) == brute_dedup(repeated_docs, 7)


def test_repeated_rows_are_not_earlier_than_each_other(make_docs, rng):
    text = prose(rng, 40)
    assert [r[2] for r in run_dedup(make_docs([(1, text), (1, text), (2, text)]))] == [0, 0, 40]
    assert [r[2] for r in run_dedup(make_docs([(1, text), (1, text + " x")]))] == [0, 0]


def brute_by_row(rows, window):
    """As ``brute_dedup``, for rows that may share an id: smaller ids and the earlier part of the same text count."""
    docs = [((-1 << 63 if d is None else d), (t or "").encode().split()) for d, t in rows]
    least, out = {}, []
    for d, w in docs:
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            least[key] = min(least.get(key, d), d)
    for d, w in docs:
        gone, seen = set(), set()
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if least[key] < d or key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((None if d == -1 << 63 else d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_documents_that_share_an_id_or_have_none(make_docs, rng):
    """A passage at different places of texts without id, or of one id; twice within one of them; and after a smaller id."""
    passage, other = prose(rng, 60), prose(rng, 30)
    rows = [(None, passage + " " + prose(rng, 30)), (None, prose(rng, 40) + " " + passage), (None, f"{other} x {prose(rng, 9)} {other} {passage} {other}"),
            (9, prose(rng, 11) + " " + other), (9, other + " " + prose(rng, 50)), (9, f"{prose(rng, 3)} {other} {other}"), (12, passage + " end")]
    rows += [(20, f"{prose(rng, 4)} la " * 30), (20, "la " * 60)]
    want = brute_by_row(rows, 20)
    assert [r[2] for r in want if r[0] is None] != [0, 0, 0]
    for settings in ({}, {"hot_segments": 1, "shard_words": 300}):
        assert run_dedup(make_docs(rows).repartition(4), **settings) == want


def test_copies_of_a_row_give_no_more_spans(make_docs, rng):
    from sluice.llm.common import texts
    passage = prose(rng, 50)
    docs = make_docs([(1, passage)] + [(2, prose(rng, 8) + " " + passage)] * 1 + [(3, "a " + passage)] * 60)
    spans = {r["did"]: len(r["spans"]) for r in substring_dedup.repeated_intervals(texts(docs)).collect()}
    assert spans[3] == spans[2]


def test_dedup_of_an_empty_table(make_docs):
    assert run_dedup(make_docs([])) == []


# --- operator 7 -------------------------------------------------------------------------
def brute_links(rows, n=5):
    sets = []
    for _, t in rows:
        w = (t or "").split()
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    links, group = [0] * len(rows), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 5 * both >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    least = defaultdict(list)
    for (d, _), g in zip(rows, group):
        least[g].append(-1 << 63 if d is None else d)
    return sorted(((-1 << 63 if d is None else d), k, min(least[g])) for (d, _), k, g in zip(rows, links, group))


def run_links(df, **settings):
    return sorted(tuple(r) for r in jaccard_join.join_similar(df, **settings).select("did", "n_links", "group_id").collect())


@pytest.fixture
def near_docs(rng):
    rows, at = [], 0
    for size in (1, 2, 5, 60):
        base = prose(rng, 150, 3000).split()
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(1000)}"
            rows.append((at, " ".join(words)))
            at += 1
    # a chain: neighbours are similar, ends are not
    base = prose(rng, 200, 3000).split()
    for k in range(8):
        rows.append((at, " ".join(base[k * 10:k * 10 + 120])))
        at += 1
    rows += [(at, rows[0][1]), (at + 1, rows[0][1]), (at + 2, ""), (at + 3, None), (at + 4, "a b"), (at + 5, "a b"), (at + 6, "a c"),
             (None, rows[3][1]), (at + 7, " \n"), (at + 8, prose(rng, 20000, 50))]
    return rows


def test_links_and_groups_equal_brute_force(make_docs, near_docs):
    want = brute_links(near_docs)
    assert run_links(make_docs(near_docs)) == want
    assert run_links(clashing(make_docs(near_docs)), block=4) == want


def test_repeated_rows_link_and_empty_tables_do_not(make_docs, rng):
    text = prose(rng, 30)
    assert run_links(make_docs([(1, text), (1, text), (2, "z")])) == [(1, 1, 1), (1, 1, 1), (2, 0, 2)]
    assert run_links(make_docs([])) == []


def test_band_plan_reaches_its_recall():
    bands, rows = jaccard_join.band_plan(0.8)
    assert 1 - (1 - 0.8 ** rows) ** bands >= jaccard_join.RECALL and bands * rows <= jaccard_join.MAX_HASHES
    with pytest.raises(ValueError):
        jaccard_join.band_plan(0.1, 0.9999, 4)


# --- operator 2 -------------------------------------------------------------------------
def brute_tiles(item, doc, least):
    """Greedy string tiling by definition: the longest unmarked match again and again."""
    item, doc = list(item), list(doc)
    marked_i, marked_d, covered = [False] * len(item), [False] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for t in range(len(doc)):
                n = 0
                while p + n < len(item) and t + n < len(doc) and item[p + n] == doc[t + n] and not marked_i[p + n] and not marked_d[t + n]:
                    n += 1
                best = max(best, (n, -p, -t))
        n, p, t = best[0], -best[1], -best[2]
        if n < least:
            return covered
        covered += n
        marked_i[p:p + n] = [True] * n
        marked_d[t:t + n] = [True] * n


def test_tiles_cover_what_the_definition_covers(rng):
    for _ in range(60):
        item = np.array([rng.randrange(6) for _ in range(rng.randrange(5, 40))], np.uint64)
        doc = np.array([rng.randrange(6) for _ in range(rng.randrange(0, 60))], np.uint64)
        tiles = decontaminate.greedy_tiles(item, doc, 3)
        for p, t, n in tiles:
            assert n >= 3 and (item[p:p + n] == doc[t:t + n]).all()
        assert len({i for p, _, n in tiles for i in range(p, p + n)}) == sum(n for _, _, n in tiles) == len({i for _, t, n in tiles for i in range(t, t + n)})
        assert [n for _, _, n in tiles] == sorted((n for _, _, n in tiles), reverse=True)
        assert sum(n for _, _, n in tiles) == brute_tiles(item.tolist(), doc.tolist(), 3)


def test_reordered_and_recased_passages_are_caught(spark, make_docs, rng):
    item = prose(rng, 40, 5000)
    words = item.split()
    swapped = " ".join(words[25:] + ["gap"] + words[:25]).upper()
    third = " ".join(words[:13])
    docs = make_docs([(1, prose(rng, 50) + " " + item), (2, f"“{swapped}!” " + prose(rng, 9)), (3, third + " " + prose(rng, 50)), (4, None), (5, ""),
                      (6, prose(rng, 20000)), (None, item), (1, item), (8, "Go. Now"), (9, "go then now")])
    bench = spark.createDataFrame([(7, item), (7, item), (8, None), (9, ""), (None, "go now")], "item_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"], r["covered"]) for r in decontaminate.contaminated(clashing(docs), clashing(bench)).collect()), key=str)
    assert got == sorted([(1, 7, 40), (1, 7, 40), (2, 7, 40), (None, 7, 40), (8, None, 2)], key=str)
    by_blocks = decontaminate.contaminated(docs, bench, block_chars=100).select("doc_id", "item_id", "covered")
    assert sorted((tuple(r) for r in by_blocks.collect()), key=str) == got


def test_a_seed_that_thousands_of_items_share(rng):
    """Candidates are those of the definition, and the time grows no faster than the items."""
    import time

    import numpy as np
    seed, cache = "common five words stand here", decontaminate.FoldedHash()
    texts = [f"{prose(rng, 6, 10 ** 6)} {seed} {prose(rng, 9, 10 ** 6)}" for _ in range(8000)] + [f"{seed} end"]
    items = [(i, cache.folded(t)) for i, t in enumerate(texts)]
    doc = cache.folded(f"{prose(rng, 300, 10 ** 6)} {seed} {texts[17]} {seed} {prose(rng, 50, 10 ** 6)} {' '.join(texts[40].split()[:9])}")
    took = []
    for n in (2000, 8001):
        seeds = decontaminate.Seeds(items[:n], 5)
        grams = {5: decontaminate.gram_hashes(doc, 5)}
        start = time.perf_counter()
        for _ in range(20):
            got = seeds.candidates(grams, 0.5)
        took.append(time.perf_counter() - start)
        own = set(grams[5].tolist())
        want = []
        for i, w in items[:n]:
            covered = set()
            for p, h in enumerate(decontaminate.gram_hashes(w, 5).tolist()):
                if h in own:
                    covered.update(range(p, p + 5))
            if 2 * len(covered) >= len(w):
                want.append(i)
        assert sorted(got) == want and 17 in want and len(want) < 10
    assert took[1] < 12 * took[0] + 0.2 and np.isfinite(took[1])


def test_no_benchmark_no_rows(spark, make_docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(make_docs([(1, "a b c d e f")]), empty).collect() == []
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.contaminated(make_docs([]), some).collect() == []
