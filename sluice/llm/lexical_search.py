"""Operator 12, ranked lexical search over norm buckets of impact vectors.

Method (after LEMP). A document is the vector of its terms' impacts, integers that rise with the term's count and
fall with the document's length; an item is the vector of its terms' weights, times their repeats; a score is
their inner product. Each task orders its documents by the length of their vectors and cuts them into buckets. A
first search, over one bucket of longest vectors a task, gives each item a score that its k-th best document has
at least. For the other buckets:

* Cauchy-Schwarz prunes a bucket if the item's length times the bucket's largest length stays below that score
  (as a filter on the stored length for all items at once, then item by item);
* so does the sum, over the item's terms, of weight times the bucket's largest impact of the term;
* inside, terms are taken in falling order of that product until the rest cannot reach the score alone. Documents
  without one of these terms drop out; the others keep their partial score and drop out if the rest, bounded by the
  smaller of both bounds above (with what their length has left), does not lift them to it;
* survivors are rescored in 64-bit integers, and the k-th best of a task raises its score further.

Bounds in doubles carry a slack for rounding, so no document is lost.

Scale. Documents are counted once, where they are read, and only the terms of items are kept; nothing but counts of
terms is shuffled. The vocabulary is sent to the tasks if its measured size is at most ``VOCABULARY_BYTES``; beyond
that, terms are joined. Items are searched in blocks of ``BLOCK_ENTRIES`` entries; a task sends at most k rows an
item. A common term costs a bucket its postings, never a group of all its documents.

Defined results. Null or empty texts have no terms and neither rank nor are ranked. Null ids stay null (a null
``doc_id`` ranks before the others among equal scores). Repeated documents are documents of their own; items repeated
with id and text count once, different texts of one id are ranked each. Empty tables give no rows. Texts of any
length are counted whole, piece by piece.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import Stored, bounded_batches, doc_id, public_id, table

K = 10
#: Documents and entries of a bucket at most, entries of a run that is ordered at once, entries of a block of items.
BUCKET = 1024
BUCKET_ENTRIES = 1 << 18
RUN_ENTRIES = 1 << 21
BLOCK_ENTRIES = 1 << 21
VOCABULARY_BYTES = 64 << 20
#: Bytes of a text that are split at once.
PIECE = 1 << 20
SLACK = 1e-9
# Terms are stretches of ASCII letters and digits and of all characters beyond ASCII; A-Z fold to a-z.
_FOLD = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256))


def count_terms(text: str) -> Counter:
    """Terms (UTF-8 bytes) of a whole text and their numbers of occurrences."""
    data, counts, at = text.encode().translate(_FOLD), Counter(), 0
    while at < len(data):
        to = data.find(b" ", at + PIECE)
        to = len(data) if to < 0 else to
        counts.update(data[at:to].split(b" "))
        at = to
    counts.pop(b"", None)
    return counts


def _count(vocabulary: dict[bytes, int] | None):
    """(id, text) -> (id, n, terms or their numbers, their counts) of the texts with terms."""
    kind = "terms" if vocabulary is None else "tids"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for key, text in zip(f["id"].tolist(), f["text"]):
                counts = count_terms(text)
                if not counts:
                    continue
                pairs = counts.items() if vocabulary is None else [(vocabulary[t], c) for t, c in counts.items() if t in vocabulary]
                out.append((key, sum(counts.values()), [t for t, _ in pairs], [c for _, c in pairs]))
            yield pd.DataFrame(out, columns=["id", "n", kind, "tfs"])
    return run


def _texts(df: DataFrame, key: str, text: str) -> DataFrame:
    return bounded_batches(df).select(doc_id(key).alias("id"), F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull())


def _counted(docs: DataFrame, vocabulary: DataFrame) -> tuple[Stored, DataFrame]:
    """The documents' counts, and (id, n, tids, tfs) restricted to the vocabulary."""
    size = vocabulary.agg(F.sum(F.length("term") + F.lit(100))).first()[0] or 0
    if size <= VOCABULARY_BYTES:
        known = {bytes(r["term"]): r["tid"] for r in vocabulary.toLocalIterator()}
        counted = Stored(docs.mapInPandas(_count(known), "id long, n long, tids array<long>, tfs array<long>"), "term-counts")
        return counted, counted.df
    counted = Stored(docs.mapInPandas(_count(None), "id long, n long, terms array<binary>, tfs array<long>"), "term-counts")
    entries = (counted.df.withColumn("row", F.monotonically_increasing_id())
               .select("row", "id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("e"))
               .select("row", "id", "n", F.col("e.terms").alias("term"), F.col("e.tfs").alias("tf")))
    found = entries.join(vocabulary, "term").groupBy("row", "id", "n").agg(F.collect_list(F.struct("tid", "tf")).alias("e"))
    return counted, found.select("id", "n", F.col("e.tid").alias("tids"), F.col("e.tf").alias("tfs"))


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)])


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of several ranges, one after the other."""
    sizes = ends - starts
    return np.repeat(starts - _starts(sizes)[:-1], sizes) + np.arange(sizes.sum())


def _buckets(n_docs: int, n_terms: int, size: int, run_entries: int):
    """Counted documents -> buckets of vectors ordered by falling length, within runs of bounded size."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, entries, runs = [], 0, 0

        def cut():
            nonlocal held, entries, runs
            ptr = _starts(np.array([len(h[2]) for h in held]))
            tids = np.concatenate([np.asarray(h[2], np.int64) for h in held])
            tfs = np.concatenate([np.asarray(h[3], np.int64) for h in held])
            # Python integers: n times the number of documents may need more than 64 bits
            m = np.array([25 + 75 * int(h[1]) * n_docs // n_terms for h in held], np.int64)
            impacts = 1_000_000_000 * tfs // (1000 * tfs + 8 * np.repeat(m, np.diff(ptr)))
            lengths = np.sqrt(np.add.reduceat(impacts.astype(float) ** 2, ptr[:-1]))
            order, ids = np.argsort(-lengths, kind="stable"), np.array([h[0] for h in held], np.int64)
            out, at = [], 0
            while at < len(order):
                in_bucket = order[at:at + size]
                weight = np.cumsum(ptr[in_bucket + 1] - ptr[in_bucket])
                in_bucket = in_bucket[:max(1, int(np.searchsorted(weight, BUCKET_ENTRIES, "right")))]
                picked = _ranges(ptr[in_bucket], ptr[in_bucket + 1])
                terms, local = np.unique(tids[picked], return_inverse=True)
                out.append({"first": runs == 0 and at == 0, "length": float(lengths[in_bucket[0]]), "ids": ids[in_bucket].tobytes(),
                            "ptr": _starts(ptr[in_bucket + 1] - ptr[in_bucket]).tobytes(), "terms": terms.tobytes(),
                            "local": local.astype(np.int32).tobytes(), "impacts": impacts[picked].astype(np.int32).tobytes()})
                at += len(in_bucket)
            held, entries, runs = [], 0, runs + 1
            return pd.DataFrame(out)

        for f in frames:
            for row in f.itertuples(index=False, name=None):
                if len(row[2]):
                    held.append(row)
                    entries += len(row[2])
                    if entries >= run_entries:
                        yield cut()
        if held:
            yield cut()
    return run


class Block:
    """Items of one block: for item ``i`` the entries from ``ptr[i]`` on, as term number and weight."""

    def __init__(self, items: list[tuple[int, list[int], list[int]]]):
        self.numbers = np.array([q for q, _, _ in items], np.int64)
        self.ptr = _starts(np.array([len(t) for _, t, _ in items]))
        self.vocabulary, self.term = np.unique(np.concatenate([np.array(t, np.int64) for _, t, _ in items]), return_inverse=True)
        self.weight = np.concatenate([np.array(w, np.int64) for _, _, w in items])
        self.length = np.sqrt(np.add.reduceat(self.weight.astype(float) ** 2, self.ptr[:-1]))


class Bucket:
    """A stored bucket, with postings by term."""

    def __init__(self, row):
        self.ids, self.ptr = np.frombuffer(row.ids, np.int64), np.frombuffer(row.ptr, np.int64)
        self.terms, self.local = np.frombuffer(row.terms, np.int64), np.frombuffer(row.local, np.int32)
        self.impacts = np.frombuffer(row.impacts, np.int32).astype(np.int64)
        self.order = np.argsort(self.local, kind="stable")
        self.posting = _starts(np.bincount(self.local, minlength=len(self.terms)))
        self.doc = np.repeat(np.arange(len(self.ids)), np.diff(self.ptr))
        squares = self.impacts.astype(float) ** 2
        self.square, self.squares = np.add.reduceat(squares, self.ptr[:-1]), squares
        self.largest = np.maximum.reduceat(self.impacts[self.order], self.posting[:-1])

    def scores(self, docs: np.ndarray, local: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of some documents."""
        dense = np.zeros(len(self.terms), np.int64)
        dense[local] = weight
        entries = _ranges(self.ptr[docs], self.ptr[docs + 1])
        return np.add.reduceat(dense[self.local[entries]] * self.impacts[entries], _starts(self.ptr[docs + 1] - self.ptr[docs])[:-1])

    def survivors(self, local: np.ndarray, weight: np.ndarray, length: float, least: int) -> np.ndarray:
        """Documents that may score ``least``, by coordinate bounds over the item's terms."""
        reach = weight * self.largest[local]
        by_reach = np.argsort(-reach, kind="stable")
        local, weight, reach = local[by_reach], weight[by_reach], reach[by_reach]
        rest = reach.sum() - np.cumsum(reach)
        rest_length = np.sqrt(np.maximum((weight.astype(float) ** 2).sum() - np.cumsum(weight.astype(float) ** 2), 0))
        bound = np.minimum(rest, rest_length * length * (1 + SLACK))
        focus = int(np.argmax(bound < least)) + 1  # the last rest is 0
        entries = self.order[_ranges(self.posting[local[:focus]], self.posting[local[:focus] + 1])]
        values = np.repeat(weight[:focus], self.posting[local[:focus] + 1] - self.posting[local[:focus]]) * self.impacts[entries]
        part = np.bincount(self.doc[entries], values, len(self.ids))
        left = np.sqrt(np.maximum(self.square - np.bincount(self.doc[entries], self.squares[entries], len(self.ids)), 0) + 1)
        most = part + np.minimum(rest[focus - 1], rest_length[focus - 1] * left * (1 + SLACK))
        return np.flatnonzero((part > 0) & (most * (1 + SLACK) + 1 >= least))


def _search(block: Block, least: np.ndarray, k: int):
    """Buckets -> at most ``k`` (item, id, score) an item and task, of scores of ``least`` or more."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        floor = least.copy()
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for f in frames:
            for row in f.itertuples(index=False):
                alive = block.length * row.length * (1 + SLACK) >= floor
                if not alive.any():
                    continue
                bucket = Bucket(row)
                at = np.minimum(np.searchsorted(block.vocabulary, bucket.terms), len(block.vocabulary) - 1)
                known = np.flatnonzero(block.vocabulary[at] == bucket.terms)
                place = np.full(len(block.vocabulary), -1)
                place[at[known]] = known
                largest = np.zeros(len(block.vocabulary), np.int64)
                largest[at[known]] = bucket.largest[known]
                alive &= np.add.reduceat(block.weight * largest[block.term], block.ptr[:-1]) >= floor
                for i in np.flatnonzero(alive).tolist():
                    entries = slice(block.ptr[i], block.ptr[i + 1])
                    local = place[block.term[entries]]
                    here = local >= 0
                    local, weight = local[here], block.weight[entries][here]
                    docs = bucket.survivors(local, weight, row.length, floor[i])
                    if not len(docs):
                        continue
                    scores = bucket.scores(docs, local, weight)
                    good = scores >= floor[i]
                    scores, ids = scores[good], bucket.ids[docs[good]]
                    if i in best:
                        scores, ids = np.concatenate([best[i][0], scores]), np.concatenate([best[i][1], ids])
                    order = np.lexsort((ids, -scores))[:k]
                    best[i] = scores[order], ids[order]
                    if len(order) == k:
                        floor[i] = max(floor[i], scores[order[-1]])
        for i, (scores, ids) in best.items():
            yield pd.DataFrame({"item": block.numbers[i], "id": ids, "score": scores})
    return run


def _blocks(vectors: DataFrame, n_docs: int) -> Iterator[Block]:
    held, entries = [], 0
    for r in vectors.toLocalIterator():
        weights = [c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for c, df in zip(r["repeats"], r["dfs"])]
        terms = [(t, w) for t, w in zip(r["tids"], weights) if w > 0]
        if terms:
            held.append((r["item"], [t for t, _ in terms], [w for _, w in terms]))
            entries += len(terms)
        if entries >= BLOCK_ENTRIES:
            yield Block(held)
            held, entries = [], 0
    if held:
        yield Block(held)


def search(items: DataFrame, documents: DataFrame, k: int = K, item_key: str = "item_id", doc_key: str = "doc_id", text: str = "text",
           bucket: int = BUCKET, run_entries: int = RUN_ENTRIES) -> DataFrame:
    """(item_key, rank, doc_key, score): the ``k`` highest-scoring documents of each item."""
    spark = documents.sparkSession
    counted = _texts(items, item_key, text).distinct().mapInPandas(_count(None), "id long, n long, terms array<binary>, tfs array<long>")
    asked = Stored(counted.withColumn("item", F.monotonically_increasing_id()), "items").df
    entries = asked.select("item", F.explode(F.arrays_zip("terms", "tfs")).alias("e")).select("item", F.col("e.terms").alias("term"), F.col("e.tfs").alias("repeats"))
    vocabulary = Stored(entries.select("term").distinct().withColumn("tid", F.monotonically_increasing_id()), "vocabulary").df
    docs, vectors = _counted(_texts(documents, doc_key, text), vocabulary)
    facts = docs.df.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    names = {"id": doc_key, "asked": item_key}
    if not facts["docs"]:
        return spark.createDataFrame([], f"`{item_key}` long, rank int, `{doc_key}` long, score long")
    buckets = Stored(vectors.mapInPandas(
        _buckets(facts["docs"], facts["terms"], bucket, run_entries),
        "first boolean, length double, ids binary, ptr binary, terms binary, local binary, impacts binary"), "norm-buckets")
    df = vectors.select(F.explode("tids").alias("tid")).groupBy("tid").agg(F.count(F.lit(1)).alias("df"))
    weighted = (entries.join(vocabulary, "term").join(df, "tid").groupBy("item")
                .agg(F.collect_list(F.struct("tid", "repeats", "df")).alias("e"))
                .select("item", F.col("e.tid").alias("tids"), F.col("e.repeats").alias("repeats"), F.col("e.df").alias("dfs")))
    best = Window.partitionBy("item").orderBy(F.desc("score"), "id")
    kept = Stored(weighted, "item-vectors")
    results = [_search_block(buckets.df, block, k, best) for block in _blocks(kept.df, facts["docs"])]
    for stored in (buckets, docs, kept):
        stored.drop()
    if not results:
        return spark.createDataFrame([], f"`{item_key}` long, rank int, `{doc_key}` long, score long")
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    ranked = found.join(asked.select("item", F.col("id").alias("asked")), "item").select(
        public_id("asked").alias("asked"), "rank", public_id("id").alias("id"), "score")
    return ranked.withColumnsRenamed(names)


def _search_block(buckets: DataFrame, block: Block, k: int, best) -> DataFrame:
    """(item, rank, id, score) of a block of items, stored."""
    schema = "item long, id long, score long"
    none = np.ones(len(block.numbers), np.int64)  # scores above 0
    first = Stored(buckets.where("first").mapInPandas(_search(block, none, k), schema), "first-search")
    ranked = first.df.withColumn("rank", F.row_number().over(best))
    kth = {r["item"]: r["score"] for r in ranked.where(F.col("rank") == k).select("item", "score").collect()}  # one number an item of the block
    least = np.array([kth.get(q, 1) for q in block.numbers.tolist()], np.int64)
    reach = float((least / block.length).min()) * (1 - SLACK)
    rest = buckets.where(~F.col("first") & (F.col("length") >= F.lit(reach))).mapInPandas(_search(block, least, k), schema)
    both = rest.unionByName(first.df).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    found = Stored(both, "found").df
    first.drop()
    return found


def query(spark, sf_dir) -> DataFrame:
    return search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents WHERE text IS NOT NULL),
b AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
facts AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(terms) AS t FROM d) GROUP BY r, t),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
m AS (SELECT r, doc_id, 25 + (75 * len(terms) * n_docs) // n_terms AS m FROM d, facts WHERE len(terms) > 0),
c AS (SELECT q, t, count(*) AS c FROM (SELECT q, unnest(terms) AS t FROM b) GROUP BY q, t),
w AS (SELECT q, t, c, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM c JOIN df USING (t), facts),
s AS (SELECT q, r, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM w JOIN tf USING (t) JOIN m USING (r) GROUP BY q, r),
best AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM s JOIN m USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM best JOIN b USING (q) WHERE rank <= 10
"""
