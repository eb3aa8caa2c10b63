"""Lexical top-k search that scores few documents: blocks of an index with their largest term counts.

Documents are ordered by length and cut into blocks; each block keeps, per term, the largest
count in it. The sum over a query's terms of weight times that count is more than any of
the block's documents can score, so blocks are taken in falling order of it and the search
ends at the first that stays below the k-th best score found. Scores are exact integers.

Either side can be the one that moves: a query set of measured size is searched in every
task that reads documents, a corpus of measured size becomes one index that every task
that reads queries searches. A task hands on at most ``k`` rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import written_table

#: Documents of a block, entries (terms of documents) of an index that a task builds at once.
BLOCK = 64
INDEX_ENTRIES = 1 << 21
#: Tokens that a task looks up at once.
LOOKED_UP = 1 << 18
FOUND = ("query", "key", "score", "scored")


class BlockIndex:
    """Documents as (term, count) entries, in blocks of documents of like length."""

    def __init__(self, keys: np.ndarray, doc: np.ndarray, term: np.ndarray, count: np.ndarray, n_terms: int, block: int = BLOCK):
        n = len(keys)
        by_length = np.argsort(-np.bincount(doc, weights=count, minlength=n), kind="stable")
        place = np.empty(n, np.int64)
        place[by_length] = np.arange(n)
        order = np.lexsort((term, place[doc]))
        self.keys, self.block, self.n_terms = keys[by_length], block, n_terms
        self.key_rank = np.argsort(np.argsort(self.keys, kind="stable"), kind="stable")  # ties go to the smaller key
        self.term, self.count = term[order], count[order].astype(np.int64)
        self.ptr = np.concatenate([[0], np.cumsum(np.bincount(place[doc], minlength=n))])
        # entries of one term and block: their largest count, ordered by term
        n_blocks = -(-n // block)
        cell = self.term * n_blocks + place[doc][order] // block
        cells, at = np.unique(cell, return_inverse=True)
        top = np.zeros(len(cells), np.int64)
        np.maximum.at(top, at, self.count)
        self.n_blocks, self.cell_block, self.cell_top = n_blocks, cells % n_blocks, top
        self.cell_ptr = np.searchsorted(cells // n_blocks, np.arange(n_terms + 1))

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, least: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
        """(scores, places of documents, documents scored): the ``k`` best of ``least`` or more."""
        sizes = self.cell_ptr[terms + 1] - self.cell_ptr[terms]
        cells = np.repeat(self.cell_ptr[terms] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        bound = np.zeros(self.n_blocks, np.int64)
        np.add.at(bound, self.cell_block[cells], np.repeat(weights, sizes) * self.cell_top[cells])
        blocks = np.argsort(-bound, kind="stable")
        dense = np.zeros(self.n_terms, np.int64)
        dense[terms] = weights
        scores, places, scored, at, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0, 1
        while at < len(blocks) and bound[blocks[at]] >= least:
            some = blocks[at:at + step]
            some = some[bound[some] >= least]
            docs = (some[:, None] * self.block + np.arange(self.block)).ravel()
            docs = docs[docs < len(self.keys)]
            lengths = self.ptr[docs + 1] - self.ptr[docs]
            entries = np.repeat(self.ptr[docs] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
            new = np.add.reduceat(dense[self.term[entries]] * self.count[entries], np.concatenate([[0], np.cumsum(lengths)[:-1]]))
            scored += len(docs)
            good = new >= least
            scores, places = np.concatenate([scores, new[good]]), np.concatenate([places, docs[good]])
            best = np.lexsort((self.key_rank[places], -scores))[:k]
            scores, places = scores[best], places[best]
            if len(scores) == k:
                least = max(least, int(scores[-1]))
            at, step = at + step, step * 2
        return scores, places, scored


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with ``LOOKED_UP`` tokens or little more, for what is derived from tokens takes many times their space; a row stays whole."""
    for batch in batches:
        tokens = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("tokens")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = tokens[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(tokens, before + LOOKED_UP, side="right")))
            yield batch.slice(at, end - at)
            at = end


def _entries(batch: pa.RecordBatch, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of a batch's token lists, for the terms of the vocabulary."""
    tokens = batch.column("tokens")
    term = pc.index_in(tokens.flatten(), value_set=vocabulary)
    known = term.is_valid().to_numpy(zero_copy_only=False)
    row = pc.list_parent_indices(tokens).to_numpy(zero_copy_only=False).astype(np.int64)[known]
    code, count = np.unique(row * max(1, len(vocabulary)) + term.drop_null().to_numpy(), return_counts=True)
    return code // max(1, len(vocabulary)), code % max(1, len(vocabulary)), count


def _counted(vocabulary: pa.Array):
    """Token lists -> the documents that hold terms of the vocabulary, with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            row, term, count = _entries(batch, vocabulary)
            rows, starts = np.unique(row, return_index=True)
            offsets = pa.array(np.append(starts, len(row)), pa.int32())
            yield pa.RecordBatch.from_pydict({
                "key": batch.column("key").take(pa.array(rows)), "terms": pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())),
                "counts": pa.ListArray.from_arrays(offsets, pa.array(count, pa.int32()))})
    return run


def _search_documents(queries: list[tuple], n_terms: int, k: int, query_type: pa.DataType, key_type: pa.DataType, block: int, index_entries: int):
    """Counted documents -> the ``k`` best of each query in this task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list = [(np.zeros(0, np.int64), []) for _ in queries]
        least, scored = [1] * len(queries), [0] * len(queries)
        held, entries = [], 0

        def look():
            nonlocal held, entries
            batch = pa.Table.from_batches(held).combine_chunks()
            lists = batch.column("terms").chunk(0)
            doc = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            keys = np.array(batch.column("key").to_pylist(), dtype=object) if not pa.types.is_integer(key_type) else batch.column("key").to_numpy()
            index = BlockIndex(keys, doc, lists.flatten().to_numpy().astype(np.int64), batch.column("counts").chunk(0).flatten().to_numpy(), n_terms, block)
            for i, (_, terms, weights) in enumerate(queries):
                scores, places, n = index.search(terms, weights, k, least[i])
                scored[i] += n
                if len(scores):
                    all_scores = np.concatenate([best[i][0], scores])
                    all_keys = [*best[i][1], *index.keys[places].tolist()]
                    order = sorted(range(len(all_keys)), key=lambda j: (-all_scores[j], all_keys[j]))[:k]
                    best[i] = all_scores[order], [all_keys[j] for j in order]
                    if len(order) == k:
                        least[i] = max(least[i], int(best[i][0][-1]))
            held, entries = [], 0

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                entries += len(batch.column("terms").flatten())
                if entries >= index_entries:
                    look()
        if held:
            look()
        out = [(q[0], key, int(s), n if j == 0 else 0) for q, (scores, keys), n in zip(queries, best, scored) for j, (s, key) in enumerate(zip(scores, keys))]
        out += [(q[0], None, None, n) for q, (scores, _), n in zip(queries, best, scored) if n and not len(scores)]
        yield _found(out, query_type, key_type)
    return run


def _search_corpus(index: BlockIndex, vocabulary: pa.Array, weight: np.ndarray, k: int, query_type: pa.DataType, key_type: pa.DataType):
    """Queries' token lists -> the ``k`` best documents of the index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            row, term, _ = _entries(batch, vocabulary)
            ids, out = batch.column("key").to_pylist(), []
            rows, starts = np.unique(row, return_index=True)
            for r, terms in zip(rows.tolist(), np.split(term, starts[1:])):
                scores, places, n = index.search(terms, weight[terms], k)
                out += [(ids[r], key, int(s), n if j == 0 else 0) for j, (s, key) in enumerate(zip(scores, index.keys[places].tolist()))]
            yield _found(out, query_type, key_type)
    return run


def _found(rows: list[tuple], query_type: pa.DataType, key_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    types = (query_type, key_type, pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=list(FOUND))


def _tokens(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    return df.select(F.col(key).alias("key"), tokens.alias("tokens"))


def _weights(df_t: DataFrame, n_docs: int) -> DataFrame:
    """(term, idf) in whole billionths, of terms that tell documents apart."""
    idf = F.floor(F.log(F.lit(float(n_docs)) / F.col("df")) * F.lit(1e9) + F.lit(0.5)).cast("bigint")
    return df_t.select("term", idf.alias("idf")).where("idf > 0")


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[column].dataType)


def _schema(queries: DataFrame, query_key: str, corpus: DataFrame, corpus_key: str) -> T.StructType:
    kinds = (queries.schema[query_key].dataType, corpus.schema[corpus_key].dataType, T.LongType(), T.LongType())
    return T.StructType([T.StructField(n, t) for n, t in zip(FOUND, kinds)])


def search_with_queries(corpus: DataFrame, queries: DataFrame, k: int, corpus_key: str, query_key: str, tokens: Column,
                        block: int = BLOCK, index_entries: int = INDEX_ENTRIES) -> DataFrame:
    """FOUND rows for a query set that is sent to the documents: read once, and kept as counts of the queries' terms."""
    spark = corpus.sparkSession
    asked = _tokens(queries, query_key, F.array_distinct(tokens)).collect()  # the caller has measured it
    words = sorted({t for r in asked for t in r["tokens"] or () if t})
    vocabulary = pa.array(words, pa.string())
    key_type = corpus.schema[corpus_key].dataType
    counted = written_table(_tokens(corpus, corpus_key, tokens).mapInArrow(_counted(vocabulary), T.StructType([
        T.StructField("key", key_type), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])), "term-counts")
    df_t = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = np.zeros(len(words), np.int64)
    for r in _weights(df_t, corpus.count()).collect():  # at most one row a term of the queries
        weight[r["term"]] = r["idf"]
    number, sent = {w: i for i, w in enumerate(words)}, []
    for r in asked:
        terms = np.array(sorted(number[t] for t in r["tokens"] or () if t), np.int64)
        terms = terms[weight[terms] > 0]
        if len(terms):
            sent.append((r["key"], terms, weight[terms]))
    found = counted.mapInArrow(_search_documents(sent, len(words), k, _arrow(queries, query_key), _arrow(corpus, corpus_key), block, index_entries),
                               _schema(queries, query_key, corpus, corpus_key))
    return found if sent else spark.createDataFrame([], found.schema)


def search_in_corpus(corpus: DataFrame, queries: DataFrame, k: int, corpus_key: str, query_key: str, tokens: Column, block: int = BLOCK) -> DataFrame:
    """FOUND rows for a corpus that is sent to the queries, as one index."""
    spark = corpus.sparkSession
    docs = _tokens(corpus, corpus_key, tokens).collect()  # the caller has measured it
    keys = [r["key"] for r in docs]
    number: dict[str, int] = {}
    cells: dict[tuple[int, int], int] = {}
    for i, r in enumerate(docs):
        for t in r["tokens"] or ():
            if t:
                cell = (i, number.setdefault(t, len(number)))
                cells[cell] = cells.get(cell, 0) + 1
    schema = _schema(queries, query_key, corpus, corpus_key)
    if not cells:
        return spark.createDataFrame([], schema)
    doc, term = (np.array(c, np.int64) for c in zip(*cells))
    df_t = spark.createDataFrame([(i, int(n)) for i, n in enumerate(np.bincount(term, minlength=len(number)))], "term int, df long")
    weight = np.zeros(len(number), np.int64)
    for r in _weights(df_t, len(docs)).collect():
        weight[r["term"]] = r["idf"]
    useful = weight[term] > 0
    count = np.fromiter(cells.values(), np.int64, len(cells))[useful]
    some, doc = np.unique(doc[useful], return_inverse=True)  # documents with such terms
    integral = isinstance(corpus.schema[corpus_key].dataType, T.IntegralType)
    index = BlockIndex(np.array([keys[i] for i in some], dtype=np.int64 if integral else object), doc, term[useful], count, len(number), block)
    return _tokens(queries, query_key, F.array_distinct(tokens)).mapInArrow(
        _search_corpus(index, pa.array(list(number), pa.string()), weight, k, _arrow(queries, query_key), _arrow(corpus, corpus_key)), schema)


def ranked(found: DataFrame, k: int, query_key: str, corpus_key: str) -> DataFrame:
    """The ``k`` best rows a query of all tasks: (query_key, rank, corpus_key, score)."""
    w = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    best = found.where(F.col("key").isNotNull()).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.select(F.col("query").alias(query_key), "rank", F.col("key").alias(corpus_key), (F.col("score").cast("double") / F.lit(1e9)).alias("score"))


def work(found: DataFrame, query_key: str = "query_id") -> DataFrame:
    """(query_key, scored): how many documents were scored for each query."""
    return found.groupBy(F.col("query").alias(query_key)).agg(F.sum("scored").alias("scored"))
