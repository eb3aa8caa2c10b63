"""Rule documents -> rules table, compact prompt lines, index change sets, and retrieval.

Rule blocks start at ``### [ID] Title`` lines. A document row is split at those lines
with one ``split`` (a lookahead keeps the heading), so every document is parsed whole
inside its own row. Retrieval is distributed: what moves between tasks is a side whose size
is measured, and text search scores few documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators import search as SE
from sluice.session import DEFAULT_BROADCAST_LIMIT, fits_broadcast

NL = "\n"
# Defaults of the rule format and of the compact prompt lines.
DEFAULT_SEVERITY = "SUGGESTION"
# A heading is one line: its parts are apart by blanks, so a heading without a title is none.
HEADING_SPLIT = r"\n(?=###[ \t]+\[[A-Z]+-[0-9]+\][ \t]+\S)"
HEADING = r"^###[ \t]+\[([A-Z]+-[0-9]+)\][ \t]+(.+?)\s*$"
FIELD = r"-\s+\*\*{name}:\*\*\s+(.+)"
SEVERITY_LINE = r"\*\*Severity:\*\*\s*(BLOCKER|SUGGESTION|STYLE)"
CITATION_LINE = r"\*\*Citation:\*\*\s*(.+)"
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def rule_blocks(docs: DataFrame, text_col: str = "block", key_cols=("doc_id",)) -> DataFrame:
    """One row per rule block of each document: (rule_no, heading line, lines after it)."""
    staged = docs.select(*key_cols, "category", F.posexplode(_block_array(F.col(text_col))).alias("rule_no", "_b"))
    lines = F.split(F.col("_b"), NL)
    return staged.select(*key_cols, "category", (F.col("rule_no") + 1).alias("rule_no"),
                         F.try_element_at(lines, F.lit(1)).alias("heading"),
                         F.slice(lines, 2, 1 << 30).alias("body_lines"))


def parse_rules(docs: DataFrame, text_col: str = "block", key_cols=("doc_id",)) -> DataFrame:
    """S-11: rules table (rule_id, title, content, citation, category, severity_hint)."""
    b = rule_blocks(docs, text_col, key_cols)
    rule_id = F.regexp_extract("heading", HEADING, 1)
    title = _strip(F.regexp_extract("heading", HEADING, 2))
    block = F.array_join("body_lines", NL)
    sev = _strip(F.regexp_extract(block, FIELD.format(name="Severity"), 1))
    cit = _strip(F.regexp_extract(block, FIELD.format(name="Citation"), 1))
    # "starts with the field marker after leading whitespace", as one anchored regex per line
    body = _strip(F.array_join(F.filter("body_lines", lambda ln: ~ln.rlike(r"^\s*- \*\*(Severity|Citation):\*\*")),
                               NL))
    return b.select(
        *key_cols, "rule_no", rule_id.alias("rule_id"), title.alias("title"),
        F.concat(title, F.lit(NL + NL), body).alias("content"),
        F.when(cit != "", cit).otherwise(F.concat(F.lit("Handbook › "), F.col("category"), F.lit(" › "), rule_id))
        .alias("citation"),
        "category",
        F.upper(F.when(sev != "", sev).otherwise(F.lit(DEFAULT_SEVERITY))).alias("severity_hint"),
    )


def _block_array(text: Column) -> Column:
    """The rule blocks of a document's text."""
    return F.slice(F.split(F.concat(F.lit(NL), F.coalesce(text, F.lit(""))), HEADING_SPLIT), 2, 1 << 30)


def _compact(block: Column, default_topic: str, body_limit: int | None) -> Column:
    """struct(rule_id, rule_line) of one block; the last Severity / Citation line wins."""
    lines = F.split(block, NL)
    heading, body_lines = F.try_element_at(lines, F.lit(1)), F.slice(lines, 2, 1 << 30)
    rule_id, title = F.regexp_extract(heading, HEADING, 1), _strip(F.regexp_extract(heading, HEADING, 2))
    non_sev = F.filter(body_lines, lambda ln: ~ln.rlike(SEVERITY_LINE))
    sev = F.regexp_extract(F.try_element_at(F.filter(body_lines, lambda ln: ln.rlike(SEVERITY_LINE)), F.lit(-1)), SEVERITY_LINE, 1)
    cit = _strip(F.regexp_extract(F.try_element_at(F.filter(non_sev, lambda ln: ln.rlike(CITATION_LINE)), F.lit(-1)), CITATION_LINE, 1))
    kept = F.filter(F.transform(F.filter(non_sev, lambda ln: ~ln.rlike(CITATION_LINE)), _strip),
                    lambda x: (x != "") & ~x.startswith("❌") & ~x.startswith("✅") & ~x.startswith("-")
                    & ~x.contains("**Severity:**") & ~x.contains("**Citation:**"))
    body = _strip(F.array_join(kept, " "))
    body = F.when(body == "", title).otherwise(body)
    if body_limit is not None:
        body = F.substring(body, 1, body_limit)
    citation = F.when(F.coalesce(cit, F.lit("")) != "", cit).otherwise(F.concat(F.lit(f"Handbook › {default_topic} › "), rule_id))
    line = F.concat(F.lit("- "), rule_id, F.lit(" ["), F.when(sev != "", sev).otherwise(F.lit(DEFAULT_SEVERITY)),
                    F.lit("] (Citation: "), citation, F.lit("): "), body)
    return F.struct(rule_id.alias("rule_id"), line.alias("rule_line"))


def compact_rules(docs: DataFrame, text_col: str = "block", key_cols=("doc_id",),
                  default_topic: str = "ML Model Lifecycle", body_limit: int | None = None) -> DataFrame:
    """S-12: one prompt line per rule: ``- ID [SEV] (Citation: ...): body``.

    Example lines (starting with the cross/check marks) and sub-bullets are dropped,
    the body falls back to the title. ``body_limit`` cuts bodies to that many characters.
    """
    blocks = docs.select(*key_cols, F.posexplode(_block_array(F.col(text_col))).alias("_n", "_b"))
    return blocks.select(*key_cols, (F.col("_n") + 1).alias("rule_no"), _compact(F.col("_b"), default_topic, body_limit).alias("_c")).select(
        *key_cols, "rule_no", "_c.rule_id", "_c.rule_line")


def rules_text(docs: DataFrame, default_rules: str, text_col: str = "block", key_cols=("doc_id",),
               default_topic: str = "ML Model Lifecycle", body_limit: int | None = None) -> DataFrame:
    """S-12: per document the compact lines joined, or the default rules when none parse; computed in the row."""
    lines = F.transform(_block_array(F.col(text_col)), lambda b: _compact(b, default_topic, body_limit)["rule_line"])
    staged = docs.select(*key_cols, lines.alias("_l"))
    n = F.size("_l")
    return staged.select(*key_cols, n.cast("bigint").alias("n_rules"),
                         F.when(n > 0, F.array_join("_l", NL)).otherwise(F.lit(default_rules)).alias("rules_text"))


def content_hash(cols: list[str]) -> Column:
    return F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(c), F.lit("")) for c in cols]), 256)


def content_hash_of(struct: str, cols=("title", "content", "citation", "category", "severity_hint")) -> Column:
    """``content_hash`` of a struct column's fields."""
    return content_hash([f"{struct}.{c}" for c in cols])


def index_change_set(old: DataFrame, new: DataFrame, key: str = "rule_id",
                     cols=("title", "content", "citation", "category", "severity_hint")) -> DataFrame:
    """ST-03: insert / update / delete rows between two snapshots by content hash.

    Only inserted and updated rows need re-embedding; unchanged rows are dropped.
    """
    o = old.select(key, content_hash(list(cols)).alias("old_hash"))
    n = new.select(key, content_hash(list(cols)).alias("new_hash"))
    j = o.join(n, key, "full_outer")
    op = (F.when(F.col("old_hash").isNull(), "insert").when(F.col("new_hash").isNull(), "delete")
          .when(F.col("old_hash") != F.col("new_hash"), "update"))
    return j.select(key, op.alias("op"), "old_hash", "new_hash").where(F.col("op").isNotNull())


# --- lexical retrieval (T-03) -----------------------------------------------------------
def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT), lambda t: t != "")


def text_top_k(corpus: DataFrame, queries: DataFrame, k: int = 3, corpus_key: str = "doc_id",
               query_key: str = "query_id", text_col: str = "text", broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Top-``k`` corpus rows per query by TF-IDF: score = sum over query terms of tf * ln(N / df).

    A corpus whose text is measured to fit the broadcast limit many times (a handbook) becomes
    one block index that the tasks reading queries search; else a query set that fits is
    searched in the tasks that read the corpus. Both score only blocks of documents that can
    hold a result (``sluice.operators.search``). Beyond that the sides are joined on the term,
    which adaptive execution splits where it is hot. idf is fixed in integer nano-units and
    sums are integral, so equal documents tie exactly.
    """
    found = text_search(corpus, queries, k, corpus_key, query_key, text_col, broadcast_limit)
    if found is not None:
        return SE.ranked(found, k, query_key, corpus_key)
    # raw splits are exploded and empty tokens dropped as rows (no array copy per document)
    terms = corpus.select(corpus_key, F.explode(F.split(F.lower(text_col), TOKEN_SPLIT)).alias("term")).where("term <> ''")
    q_terms = queries.select(query_key, F.explode(F.array_distinct(tokens(F.col(text_col)))).alias("term"))
    n_docs = corpus.agg(F.count(F.lit(1)).alias("n")).scalar()
    # idf in integer nano-units: floor(x * 1e9 + 0.5) is the same in every IEEE engine
    idf = F.floor(F.log(n_docs.cast("double") / F.col("df")) * F.lit(1e9) + F.lit(0.5)).cast("bigint")
    vocabulary = q_terms.select("term").distinct()
    df_t = (corpus.select(F.explode(F.array_distinct(F.split(F.lower(text_col), TOKEN_SPLIT))).alias("term"))
            .join(vocabulary, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    weights = df_t.select("term", idf.alias("idf")).where("idf > 0")  # other terms add nothing to any score
    # the tokens that a query holds, dealt by document: term counts and scores then need no further shuffle
    tf = (terms.join(vocabulary, "term", "left_semi").repartition(corpus_key)
          .groupBy(corpus_key, "term").agg(F.count(F.lit(1)).alias("tf")))
    pairs = tf.join(q_terms.join(weights, "term"), "term").select(query_key, corpus_key, (F.col("tf") * F.col("idf")).alias("w"))
    scores = pairs.groupBy(query_key, corpus_key).agg(F.sum("w").alias("_score_e9")).withColumn("_score", F.col("_score_e9").cast("double") / F.lit(1e9))
    w = Window.partitionBy(query_key).orderBy(F.desc("_score_e9"), corpus_key)
    return (scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(query_key, "rank", corpus_key, F.col("_score").alias("score")))


def text_search(corpus: DataFrame, queries: DataFrame, k: int = 3, corpus_key: str = "doc_id", query_key: str = "query_id",
                text_col: str = "text", broadcast_limit: int = DEFAULT_BROADCAST_LIMIT, **index) -> DataFrame | None:
    """The rows that the block search finds, task by task (``search.ranked`` and ``search.work`` read them); None if neither side fits."""
    split = F.split(F.lower(F.col(text_col)), TOKEN_SPLIT)

    def fits(df: DataFrame, bytes_a_character: int) -> bool:
        if not fits_broadcast(df, broadcast_limit):  # the optimizer's guess, without a job
            return False
        return (df.agg(F.sum(F.length(text_col))).first()[0] or 0) * bytes_a_character <= broadcast_limit

    if fits(corpus, 32):
        return SE.search_in_corpus(corpus, queries, k, corpus_key, query_key, split, **index)
    if fits(queries, 8):
        return SE.search_with_queries(corpus, queries, k, corpus_key, query_key, split, **index)
    return None


# --- vector retrieval (T-02) ------------------------------------------------------------
def _finite(v: Column) -> Column:
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def vector_top_k(corpus: DataFrame, queries: DataFrame, k: int = 3, key: str = "vec_id",
                 vec: str = "embedding", exclude_self: bool = True, query_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Top-``k`` cosine neighbours of each query vector, ranked by the exact cosine, ties to the smaller key.

    The reported score is rounded to 6 decimals after ranking. Vectors without length, with null or
    non-finite entries, or of another length than the query's take no part. A query set that is measured
    to fit ``query_limit`` is sent to the tasks that read the corpus; beyond it, blocks of that size are
    searched one after the other. A task multiplies tiles of rows and queries, each of bounded size, and
    holds the ``k`` best rows of each query by the exact cosine, as arrays; these rows are ranked over all tasks.
    """
    q = queries.where(_finite(F.col(vec))).select(F.col(key).alias("query_id"), F.col(vec).cast("array<double>").alias("_qv"))
    c = corpus.where(_finite(F.col(vec))).select(F.col(key).alias("match_id"), F.col(vec).cast("array<double>").alias("_v"))
    shipped = q.agg(F.sum(F.size("_qv") * 8 + 32)).first()[0] or 0
    blocks = max(1, -(-int(shipped) // query_limit))
    found = T.StructType([T.StructField("query_id", queries.schema[key].dataType), T.StructField("match_id", corpus.schema[key].dataType),
                          T.StructField("_cos", T.DoubleType())])
    w = Window.partitionBy("query_id").orderBy(F.desc("_cos"), "match_id")
    best = None
    for block in range(blocks):
        part = q if blocks == 1 else q.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        sent = part.toArrow()  # measured
        if best is not None and not sent.num_rows:
            continue
        near = c.mapInArrow(_nearest(sent, k, exclude_self), found)
        top = near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        best = top if best is None else best.unionByName(top)
    return best.select("query_id", "rank", "match_id", F.col("_cos").cast("decimal(20,6)").cast("double").alias("score"))


#: Cosines of a matrix product and of the exact formula differ by less.
NEARLY = 1e-9
#: Rows of a tile at most, and its cosines, the entries of its rows, and of vectors whose exact cosines a task takes at once.
TILE_ROWS, TILE = 1 << 13, 1 << 21


def _rows_of_length(n: int) -> int:
    """Rows of a tile of vectors with ``n`` entries: wide vectors are taken in smaller pieces."""
    return max(1, min(TILE_ROWS, TILE // n))


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed from the first entry to the last."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; neither overflows nor underflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _ranks(keys: pa.Array) -> np.ndarray:
    return pc.rank(keys, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)


class _Rows:
    """Corpus vectors of one length, of equal ones no more than can count; ``code`` says which query id a row's key is."""

    def __init__(self, keys: pa.Array, x: np.ndarray, codes: dict, k: int):
        same, copy = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.shape[1] * 8))).ravel(), return_inverse=True)
        if len(same) < len(x):  # k rows of a key, 2 k rows of a vector: k are left without those of the query's own key
            rank = _ranks(keys)
            order = np.lexsort((rank, copy))
            order = order[_places(copy[order] * (int(rank.max()) + 1) + rank[order]) < k]
            order = np.sort(order[_places(copy[order]) < 2 * k])
            keys, x = keys.take(pa.array(order)), x[order]
        self.keys, self.x, self.unit, self.root = keys, x, _unit(x), np.sqrt(_dots(x, x))
        code = np.array([codes.get(v, -1) for v in keys.to_pylist()], np.int64)
        self.asked = np.flatnonzero(code >= 0)
        self.code = code[self.asked]


def _places(group: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each run of equal values."""
    at = np.arange(len(group))
    first = np.ones(len(group), bool)
    first[1:] = group[1:] != group[:-1]
    return at - np.maximum.accumulate(np.where(first, at, 0))


class _Tile:
    """Query vectors of one length with the ``k`` nearest rows seen: ``held`` are (query, cosine of the product, exact cosine, its lack)."""

    def __init__(self, place: np.ndarray, code: np.ndarray, vectors: np.ndarray, k: int):
        self.place, self.code, self.vectors, self.k = place, code, vectors, k
        self.unit, self.root = _unit(vectors), np.sqrt(_dots(vectors, vectors))
        self.floor = np.full(len(place), -np.inf)
        self.held, self.keys = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0), np.zeros(0, bool)), None

    def see(self, rows: _Rows, exclude_self: bool) -> None:
        cos = self.unit @ rows.unit.T
        if exclude_self and len(rows.asked):
            j, r = np.nonzero(self.code[:, None] == rows.code[None, :])
            cos[j, rows.asked[r]] = -np.inf
        floor, n = self.floor, cos.shape[1]
        near = cos >= floor[:, None] - NEARLY
        if n > self.k and np.count_nonzero(near) > 4 * self.k * len(cos):  # the k-th best of the tile bounds what can count
            floor = np.maximum(floor, -np.partition(-cos, self.k - 1, axis=1)[:, self.k - 1])
            near = cos >= floor[:, None] - NEARLY
        near &= cos > -np.inf
        step = max(1, TILE // max(1, n))
        for at in range(0, len(cos), step):
            j, r = np.nonzero(near[at:at + step])
            if len(j):
                self._add(j + at, r, cos, rows)

    def _add(self, j: np.ndarray, r: np.ndarray, cos: np.ndarray, rows: _Rows) -> None:
        exact, lacking, some = np.empty(len(j)), np.empty(len(j), bool), max(1, TILE // rows.x.shape[1])
        for at in range(0, len(j), some):
            a, b = j[at:at + some], r[at:at + some]
            with np.errstate(all="ignore"):
                product = self.root[a] * rows.root[b]
                exact[at:at + some] = _dots(self.vectors[a], rows.x[b]) / product
            lacking[at:at + some] = product == 0
        query, near, value, lack = (np.concatenate(x) for x in zip(self.held, (j, cos[j, r], exact, lacking)))
        keys = rows.keys.take(pa.array(r))
        keys = keys if self.keys is None else pa.concat_arrays([self.keys, keys])
        falling = np.where(lack, np.inf, np.where(np.isnan(value), -np.inf, -value))  # NaN is the largest, a missing one the last
        order = np.lexsort((_ranks(keys), falling, query))
        order = order[_places(query[order]) < self.k]
        self.held, self.keys = (query[order], near[order], value[order], lack[order]), keys.take(pa.array(order))
        query, near = self.held[:2]
        starts = np.flatnonzero(_places(query) == 0)
        full = np.diff(np.append(starts, len(query))) == self.k
        self.floor[query[starts[full]]] = np.maximum(self.floor[query[starts[full]]], np.minimum.reduceat(near, starts)[full])


def _nearest(queries: pa.Table, k: int, exclude_self: bool):
    """Batches of vectors -> the ``k`` nearest of each query in this task, with the exact cosine."""
    ids, column = queries.column("query_id").combine_chunks(), queries.column("_qv").combine_chunks()
    ids, column = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (ids, column))
    lengths, flat = pc.list_value_length(column).to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    asked = {}
    for n in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == n)
        vectors = flat[starts[at][:, None] + np.arange(n)]
        asked[n] = at[vectors.any(1)], vectors[vectors.any(1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = {v: i for i, v in enumerate(dict.fromkeys(ids.to_pylist()))}
        code = np.array([codes[v] for v in ids.to_pylist()], np.int64)
        tiles = {}
        for n, (at, vectors) in asked.items():
            step = TILE // _rows_of_length(n)
            tiles[n] = [_Tile(at[i:i + step], code[at[i:i + step]], vectors[i:i + step], k) for i in range(0, len(at), step)]
        for batch in batches:
            lengths = pc.list_value_length(batch.column("_v")).to_numpy(zero_copy_only=False)
            flat = batch.column("_v").flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            for n, some in tiles.items():
                of_length, step = np.flatnonzero(lengths == n), _rows_of_length(n)
                for at in range(0, len(of_length), step):
                    rows = of_length[at:at + step]
                    x = flat[starts[rows][:, None] + np.arange(n)]
                    rows, x = rows[x.any(1)], x[x.any(1)]
                    if len(rows):
                        seen = _Rows(batch.column("match_id").take(pa.array(rows)), x, codes, k)
                        for tile in some:
                            tile.see(seen, exclude_self)
        for tile in (t for some in tiles.values() for t in some if t.keys is not None):
            query, _, value, lack = tile.held
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(tile.place[query])), tile.keys, pa.array(value, mask=lack)], names=["query_id", "match_id", "_cos"])
    return run


def label_centroids(vectors: DataFrame, label: str = "label", vec: str = "embedding", scale: float = 1e6) -> DataFrame:
    """One query vector per label: the sum of its members' vectors (cosine ignores scale).

    Components are quantized to integers (``floor(x * scale + 0.5)``) before summing, so
    the centroid is exact and independent of summation order. The sum runs as a
    (label, dimension) aggregation with a map-side combine, so a dominant label is fine.
    (``pyspark.ml.stat.Summarizer`` avoids the per-dimension rows but derives its sum from
    a running mean, which is not exact.)
    """
    parts = vectors.select(label, F.posexplode(vec).alias("_i", "_x")).groupBy(label, "_i").agg(
        F.sum(F.floor(F.col("_x").cast("double") * F.lit(scale) + F.lit(0.5)).cast("bigint")).alias("_s"))
    return parts.groupBy(label).agg(F.array_sort(F.collect_list(F.struct("_i", "_s"))).alias("_c")).select(
        F.col(label).alias("query_id"), F.transform("_c", lambda e: e["_s"]).alias(vec))


def retrieval_checks(top: DataFrame, expected: DataFrame) -> DataFrame:
    """A-14: per query, top-1 equals ``expect_exact`` or any of the top ranks has ``expect_prefix``."""
    j = top.join(expected, "query_id")
    agg = j.groupBy("query_id").agg(
        F.min_by("match", "rank").alias("top1"),
        F.bool_or(F.col("match").startswith(F.col("expect_prefix"))).alias("_any_prefix"),
        F.first("expect_exact", ignorenulls=True).alias("expect_exact"),
        F.first("expect_prefix", ignorenulls=True).alias("expect_prefix"))
    passed = F.when(F.col("expect_exact").isNotNull(), F.col("top1") == F.col("expect_exact")).otherwise(
        F.coalesce(F.col("_any_prefix"), F.lit(False)))
    return agg.select("query_id", "top1", "expect_exact", "expect_prefix", passed.alias("passed"))


def text_retrieval_checks(top: DataFrame, corpus: DataFrame, queries: DataFrame, corpus_key: str = "doc_id",
                          query_key: str = "query_id", text_col: str = "text") -> DataFrame:
    """A-14 (lexical): the top-1 document must contain the query passage."""
    t1 = top.where(F.col("rank") == 1).select(query_key, corpus_key)
    j = (queries.select(query_key, F.col(text_col).alias("_q"))
         .join(t1, query_key, "left")
         .join(corpus.select(corpus_key, F.col(text_col).alias("_d")), corpus_key, "left"))
    return j.select(query_key, F.col(corpus_key).alias("top1"),
                    F.coalesce(F.col("_d").contains(F.col("_q")), F.lit(False)).alias("passed"))
