"""Operator 1, substring dedup: words covered by a window that already started earlier are removed.

Method. Every ``window``-word window belongs to the least hash of its ``seed``-word grams (its key), so
equal windows share a key wherever they stand. Runs of windows with one key are segments. Segments whose
key occurs once in the corpus cannot repeat. The others go, by key, to shards of bounded size, each copy
of a segment once, and every shard builds a compressed FM-index (``fm_index``) of them. The same segments
are streamed through backward search over the wavelet tree; the matching statistics give the windows that
match in full and, from the first row of their interval, the earliest occurrence. Windows that start later
than their earliest occurrence are reported as intervals, joined back to all copies, and cut out.

Skew. Copies of a segment meet in a map-side aggregate; a key with more than ``hot_segments`` different
segments goes to no shard but is split into its windows, which are keyed by their whole word sequence. Equal
windows share their segments' key, so a window's earliest occurrence is the least place with its words: a
map-side aggregate, joined back to the windows. Joins on keys are plain equi-joins that adaptive execution can split.

Defined results. Null or empty text: no words, nothing removed, the hash of the empty string. Null doc_id:
the smallest id. Repeated rows (same id and text) start at the same place, so neither is earlier. Rows of
one id (or none) with different texts are documents of equal rank: none is earlier than the other, and a
window is judged against documents of smaller ids and the earlier part of its own text. An empty table gives
no rows, columns beside ``doc_id`` and ``text`` are ignored. Texts of any length are read whole, one at a time.
Words are compared by 64-bit hashes, copies of segments and windows of hot keys by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import BASE, U64, Stored, WordHash, chunks, gram_hashes, mix, public_id, texts
from sluice.llm.fm_index import FMIndex

WINDOW = 20
SEED = 8
#: Windows in a segment at most; longer runs (periodic text) are cut into several.
RUN = 64
CHUNK_BYTES = 4 << 20
#: Words that a shard indexes, about; and different segments of one key beyond which it is split.
SHARD_WORDS = 750_000
HOT_SEGMENTS = 20_000
INTERVALS = "key long, seg long, lo int, n_hit int, first_did long, first_tv long, first_start int"


def segments_of(words: np.ndarray, bounds: np.ndarray, window: int, seed: int, run: int = RUN):
    """(document, start, windows, key, content hash, key occurrences up to 2) of each segment.

    ``words`` are the hashes of several documents one after the other, ``bounds`` where each begins and ends.
    """
    width = window - seed + 1
    lengths = np.diff(bounds)
    n_windows = np.maximum(lengths - window + 1, 0)
    total = int(n_windows.sum())
    if not total:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, U64, U64, np.int64))
    grams = gram_hashes(words, seed)
    low, have = grams, 1  # least gram over `have` positions
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[:-(width - have)], low[width - have:])
    owner = np.repeat(np.arange(len(lengths)), n_windows)
    first = np.cumsum(n_windows) - n_windows
    at = np.arange(total) - first[owner] + bounds[:-1][owner]
    key = low[at]
    new = np.ones(total, bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    since = np.arange(total) - head[np.cumsum(new) - 1]
    head = np.flatnonzero(since % run == 0)
    n = np.diff(np.append(head, total))
    start, key = at[head], key[head]
    leftmost, rightmost = np.full(len(head), -1), np.full(len(head), -1)
    for j in range(width):
        hit = (grams[start + j] == key) & (leftmost < 0)
        leftmost[hit] = start[hit] + j
        hit = grams[start + n - 1 + j] == key
        rightmost[hit] = start[hit] + n[hit] - 1 + j
    powers = np.cumprod(np.full(len(words), BASE, U64))
    sums = np.zeros(len(words) + 1, U64)
    np.cumsum(words * powers, out=sums[1:])
    inverse = np.cumprod(np.full(len(words), U64(pow(int(BASE), -1, 1 << 64)), U64))
    content = mix((sums[start + n + window - 1] - sums[start]) * inverse[start] + n.astype(U64))
    return owner[head], start - bounds[:-1][owner[head]], n, key, content, 1 + (leftmost != rightmost)


def words_of(text: str) -> list[bytes]:
    """Words are what stands between ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split()


def _hashed(rows: list[tuple], cache: WordHash) -> tuple[np.ndarray, np.ndarray]:
    cache.trim()
    arrays = [cache.array(words_of(r[-1])) for r in rows]
    bounds = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(a) for a in arrays], out=bounds[1:])
    return np.concatenate(arrays), bounds


def _segment_rows(window: int, seed: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHash()
        for rows in chunks(frames, CHUNK_BYTES):
            doc, start, n, key, content, occurs = segments_of(*_hashed(rows, cache), window, seed)
            ids = np.array([r[0] for r in rows], np.int64)
            versions = np.array([r[1] for r in rows], np.int64)
            yield pd.DataFrame({"key": key.view(np.int64), "seg": content.view(np.int64), "did": ids[doc], "tv": versions[doc],
                                "start": start.astype(np.int32), "n": n.astype(np.int16), "occurs": occurs.astype(np.int16)})
    return run


def _extract(window: int):
    """Documents with the list of segments wanted from them -> a row with the words of each segment."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHash()
        for rows in chunks(frames, CHUNK_BYTES):
            words, bounds = _hashed(rows, cache)
            out = []
            for (did, tv, wanted, _), base, end in zip(rows, bounds, bounds[1:]):
                doc = words[base:end]
                for w in wanted:
                    start = w["start"]
                    out.append((w["key"], w["seg"], did, tv, start, doc[start:start + w["n"] + window - 1].tobytes()))
            if out:
                yield pd.DataFrame(out, columns=["key", "seg", "did", "tv", "start", "words"])
    return run


def _windows(window: int):
    """The same of segments of hot keys -> a row for each of their windows, with two hashes of all its words."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHash()
        for rows in chunks(frames, CHUNK_BYTES):
            words, bounds = _hashed(rows, cache)
            for (did, tv, wanted, _), base, end in zip(rows, bounds, bounds[1:]):
                doc, parts = words[base:end], []
                for w in wanted:
                    start, n = w["start"], w["n"]
                    span = doc[start:start + n + window - 1]
                    check = np.array([xxhash.xxh3_64_intdigest(span[i:i + window].tobytes()) for i in range(n)], U64)
                    off = np.arange(n, dtype=np.int32)
                    parts.append(pd.DataFrame({"key": w["key"], "seg": w["seg"], "lo": off, "n_hit": np.int32(1), "first_did": did, "first_tv": tv,
                                               "first_start": (start + off).astype(np.int32), "skey": gram_hashes(span, window).view(np.int64),
                                               "chk": check.view(np.int64)}))
                if parts:
                    yield pd.concat(parts, ignore_index=True)
    return run


def _search_shard(window: int):
    """One shard: index its segments, stream them through it, report intervals with their earliest occurrence."""
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["did", "tv", "start"], kind="stable")
        sequences = [np.frombuffer(w, U64) for w in shard["words"]]
        index = FMIndex(sequences, window)
        lengths, rows, _ = index.matching_statistics(sequences)
        sizes = np.array([len(s) for s in sequences])
        base = np.cumsum(sizes) - sizes
        query = np.repeat(np.arange(len(sequences)), sizes)
        full = np.flatnonzero(lengths >= window)
        query, offset = query[full], full - base[query[full]]
        source, source_off = index.earliest(rows[full])
        new = np.ones(len(full), bool)
        new[1:] = ((query[1:] != query[:-1]) | (source[1:] != source[:-1]) | (offset[1:] != offset[:-1] + 1)
                   | (source_off[1:] != source_off[:-1] + 1))
        head = np.flatnonzero(new)
        n = np.diff(np.append(head, len(full)))
        q, s = query[head], source[head]
        return pd.DataFrame({
            "key": shard["key"].to_numpy()[q], "seg": shard["seg"].to_numpy()[q], "lo": offset[head].astype(np.int32),
            "n_hit": n.astype(np.int32), "first_did": shard["did"].to_numpy()[s], "first_tv": shard["tv"].to_numpy()[s],
            "first_start": (shard["start"].to_numpy()[s] + source_off[head]).astype(np.int32)})
    return run


def repeated_intervals(docs: DataFrame, window: int = WINDOW, seed: int = SEED, shard_words: int = SHARD_WORDS,
                       hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """(did, tv, spans): per document the word intervals [a, b) covered by windows that start earlier elsewhere.

    ``docs`` has (did, tv, text) as ``common.texts`` makes them. Documents without such words are absent.
    """
    found = Stored(docs.mapInPandas(_segment_rows(window, seed),
                                    "key long, seg long, did long, tv long, start int, n short, occurs short"), "segments")
    repeated = found.df.groupBy("key").agg(F.sum("occurs").alias("c")).where("c > 1").select("key")
    shared = Stored(found.df.drop("occurs").join(repeated, "key", "left_semi"), "shared-segments")
    found.drop()
    s = shared.df
    distinct = s.groupBy("key", "seg").agg(F.min(F.struct("did", "tv", "start")).alias("f"), F.first("n").alias("n"))
    # one count of the rows: how many shards, and whether any key can be hot
    size = s.groupBy("key").agg(F.count(F.lit(1)).alias("c")).agg(F.sum("c").alias("all"), F.max("c").alias("most")).first()
    any_hot = (size["most"] or 0) > hot_segments
    if any_hot:  # most frequent keys have few different segments: their texts need no second pass
        frequent = s.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > hot_segments).select("key")
        different = s.join(frequent, "key", "left_semi").select("key", "seg").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("c"))
        hot = Stored(different.where(F.col("c") > hot_segments).select("key"), "hot-keys").df
        any_hot = not hot.isEmpty()

    if any_hot:
        distinct = distinct.join(hot.withColumn("hot", F.lit(True)), "key", "left").fillna(False, ["hot"])
    else:
        distinct = distinct.withColumn("hot", F.lit(False))
    # a row per document and text with the segments wanted from it
    wanted = distinct.groupBy("f.did", "f.tv").agg(F.collect_list(F.struct("key", "seg", F.col("f.start").alias("start"), "n", "hot")).alias("wanted"))
    joined = docs.join(wanted, ["did", "tv"])

    def with_text(some) -> DataFrame:
        """The documents with segments for which ``some`` holds; repeated rows of a document would only repeat them."""
        chosen = joined.where(F.exists("wanted", some)).dropDuplicates(["did", "tv"])
        return chosen.select("did", "tv", F.filter("wanted", some).alias("wanted"), "text")

    shards = max(1, (size["all"] or 0) * (window + (window - seed) // 2) // shard_words)
    intervals = (with_text(lambda w: ~w["hot"]).mapInPandas(_extract(window), "key long, seg long, did long, tv long, start int, words binary")
                 .groupBy(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")).applyInPandas(_search_shard(window), INTERVALS))
    if any_hot:
        # in one job with the others, so that the texts are dealt by document once
        windows = with_text(lambda w: w["hot"]).mapInPandas(_windows(window), f"{INTERVALS}, skey long, chk long")
        both = Stored(intervals.withColumns({"skey": F.lit(None).cast("bigint"), "chk": F.lit(None).cast("bigint")}).unionByName(windows), "intervals")
        hot_windows = both.df.where(F.col("skey").isNotNull())
        least = hot_windows.groupBy("skey", "chk").agg(F.min(F.struct("first_did", "first_tv", "first_start")).alias("first"))
        found_hot = Stored(hot_windows.drop("first_did", "first_tv", "first_start").join(least, ["skey", "chk"]).select(
            "key", "seg", "lo", "n_hit", "first.*"), "hot-intervals")
        searched = both.df.where(F.col("skey").isNull()).drop("skey", "chk").unionByName(found_hot.df)
    else:
        searched = Stored(intervals, "intervals").df
    here = F.col("start") + F.col("lo")
    hits = s.join(searched, ["key", "seg"]).withColumn("here", here)
    same_id, same_text = F.col("first_did") == F.col("did"), F.col("first_tv") == F.col("tv")
    later = (F.col("first_did") < F.col("did")) | (same_id & same_text & (F.col("first_start") < F.col("here")))
    spans = [hits.where(later).select("did", "tv", _span(window, F.col("n_hit")))]
    if not s.groupBy("did").agg(F.min("tv").alias("a"), F.max("tv").alias("b")).where("a <> b").isEmpty():
        spans.append(_within_texts(hits.where(same_id & ~same_text), window))
    # a set: the copies of a repeated row give the same spans
    return reduce(DataFrame.unionByName, spans).groupBy("did", "tv").agg(F.collect_set("span").alias("spans"))


def _span(window: int, n):
    return F.struct(F.col("here").alias("a"), (F.col("here") + n + F.lit(window - 1)).alias("b")).alias("span")


def _within_texts(hits: DataFrame, window: int) -> DataFrame:
    """Spans of windows whose first occurrence is in another text of the same id, but that also stand earlier in their own.

    The first occurrence names the window's words, so windows of a text with one first occurrence are equal.
    """
    each = hits.select("did", "tv", "first_tv", F.explode(F.sequence(F.lit(0), F.col("n_hit") - 1)).alias("i"), "here", "first_start").select(
        "did", "tv", "first_tv", (F.col("first_start") + F.col("i")).alias("first_start"), (F.col("here") + F.col("i")).alias("here"))
    key = ["did", "tv", "first_tv", "first_start"]
    own = each.groupBy(*key).agg(F.min("here").alias("own"))
    return each.join(own, key).where("own < here").select("did", "tv", _span(window, F.lit(1)))


def _kept(words: list[bytes], spans) -> tuple[list[bytes], int]:
    if spans is None or not len(spans):
        return words, 0
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, [s["a"] for s in spans], 1)
    np.add.at(depth, [s["b"] for s in spans], -1)
    keep = np.cumsum(depth[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist()) if k], int(len(words) - keep.sum())


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in chunks(frames, CHUNK_BYTES):
        out = []
        for *head, spans, text in rows:
            words = words_of(text)
            kept, removed = _kept(words, spans)
            kept_text = b" ".join(kept)
            out.append((*head, len(words), removed, hashlib.sha256(kept_text).hexdigest(),
                        kept_text.decode("utf-8", "surrogatepass") if removed else text))
        yield pd.DataFrame(out, columns=["did", "tv", "n_words", "n_removed", "kept_sha256", "kept_text"])


@F.pandas_udf(T.StringType())
def cut_spans(text: pd.Series, spans: pd.Series) -> pd.Series:
    """The words of a text that no span covers, joined by one space."""
    return pd.Series([b" ".join(_kept(words_of(t or ""), s)[0]).decode("utf-8", "surrogatepass") for t, s in zip(text, spans)])


def dedup_substrings(documents: DataFrame, window: int = WINDOW, seed: int = SEED, **limits) -> DataFrame:
    """Per document: (did, tv, n_words, n_removed, kept_sha256, kept_text).

    ``kept_sha256`` is of the kept words joined by one space; ``kept_text`` is that string where words
    were removed, and the unchanged text elsewhere. Other arguments: ``repeated_intervals``.
    """
    docs = texts(documents)
    spans = repeated_intervals(docs, window, seed, **limits)
    return (docs.join(spans, ["did", "tv"], "left").select("did", "tv", "spans", "text")
            .mapInPandas(_cut, "did long, tv long, n_words long, n_removed long, kept_sha256 string, kept_text string"))


def query(spark, sf_dir) -> DataFrame:
    from sluice.llm.common import table
    out = dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select(public_id("did").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


#: DuckDB: windows as word lists; late are those with a smaller id or an earlier start in the same row.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775808) AS did,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, did, i, md5(array_to_string(w[i:i + 19], ' ')) AS h
        FROM (SELECT r, did, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
late AS (SELECT r, i FROM (SELECT r, did, i, min(did) OVER (PARTITION BY h) AS least, min(i) OVER (PARTITION BY h, r) AS own FROM win)
         WHERE least < did OR own < i),
gone AS (SELECT r, list(DISTINCT p) AS gone FROM (SELECT r, unnest(range(i, i + 20)) AS p FROM late) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
         list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (r)
"""
