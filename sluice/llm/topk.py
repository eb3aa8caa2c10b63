"""Operator 3, exact top-k search by inner product with a pivot-distance index.

Method. Vectors become integers, and one more component lifts all of them to the largest norm, so that the
inner product with a query falls as the Euclidean distance rises and the triangle inequality holds. A
bounded number of rows are pivots. Every vector is keyed by its nearest pivot and its distance to it;
sorted by that key, the rows are cut into annuli of at most ``ring`` rows. Queries are blocked in the same
order. Each block of queries first searches the two annuli next to its own distance around its own pivot, found
by one window a pivot over the annuli's directory. That gives a k-th best score per query; the worst of them says
how far the distances of a block and an annulus to a pivot may differ, and the block expands to the annuli of every
pivot within that reach, met by equal cells of distance and so only where they can be. Scores are exact
integers; the bounds carry a slack for rounding, so nothing is lost.

Skew. Equal vectors are kept by their ``k + 1`` smallest ids before anything else (more cannot be in a
result, one may be the query itself); Spark applies that limit before the shuffle. The annuli bound every
task's memory; the directory that is joined has one small row an annulus.

Defined results. Vectors that are null, hold null or hold a non-finite component take no part, nor do rows
with a null id. Shorter vectors count as padded with zeros. A component beyond ``LIMIT`` counts as that. Rows
repeated with the same id and vector count once; different vectors of one id are candidates each (so an id may
fill several ranks), and the id's result is the best of what its vectors find. Ties go to the smaller id. Fewer
than ``k`` rows: all of them. An empty table gives no rows, columns beside ``key`` and ``vec`` are ignored.
Scores are exact decimals of 38 digits, for vectors of up to a million components; a query takes them as longs, null
where they are no long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import Stored

K = 5
SCALE = 256
#: Pivots at most, rows of an annulus and queries of a block at most.
PIVOTS = 32
RING = 512
BLOCK = 128
#: Cells that the range of distances is cut into, to find annuli within reach by equal cells.
CELLS = 1024
#: Largest magnitude of a component; scores below the first bound are exact sums of doubles, below the second of longs.
LIMIT = 1 << 53
DOUBLES, LONGS = 1 << 53, 1 << 62


def integer_vectors(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, vec): distinct rows with floor(scale * component) as integers."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.where(F.col(key).isNotNull() & F.col(vec).isNotNull() & finite)
            .select(F.col(key).cast("bigint").alias("id"),
                    F.transform(vec, lambda x: _limited(F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))).alias("vec"))
            .dropDuplicates())


def _limited(x):
    return F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), x))


def _matrix(column, dims: int, kind=float) -> np.ndarray:
    out = np.zeros((len(column), dims), kind)
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    return np.sqrt(np.maximum(top - (x * x).sum(1), 0))


def _to_pivots(x: np.ndarray, pivots: np.ndarray, top: float, is_query: bool) -> np.ndarray:
    """Distances to the lifted pivots; a query's own lifted component is 0."""
    lifted = 0 if is_query else _lift(x, top)[:, None] * _lift(pivots, top)[None, :]
    norms = (x * x).sum(1)[:, None] if is_query else top
    return np.sqrt(np.maximum(norms + top - 2 * (x @ pivots.T + lifted), 0))


def _assign(pivots: np.ndarray, top: float, dims: int, is_query: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                d = _to_pivots(_matrix(f["vec"], dims), pivots, top, is_query)
                near = d.argmin(1)
                yield pd.DataFrame({"id": f["id"], "vec": f["vec"], "pivot": near.astype(np.int32), "dist": d[np.arange(len(d)), near]})
    return run


def _blocks(size: int, dims: int, pivots: np.ndarray, top: float, is_query: bool):
    """Rows sorted by (pivot, distance) -> one row per run of at most ``size`` rows of one pivot."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        number, held = TaskContext.get().partitionId() << 33, None

        def block(rows):
            nonlocal number
            x = _matrix(rows["vec"], dims, np.int64)
            number += 1
            d = _to_pivots(x.astype(float), pivots, top, is_query)
            own = d[:, int(rows["pivot"].iloc[0])]
            return {"block": number - 1, "pivot": int(rows["pivot"].iloc[0]), "lo": own.min(), "hi": own.max(),
                    "ids": rows["id"].to_numpy(np.int64).tobytes(), "vecs": x.tobytes(),
                    "los": d.min(0).tolist(), "his": d.max(0).tolist(), "norm": float((x.astype(float) ** 2).sum(1).max())}

        for f in frames:
            held = f if held is None else pd.concat([held, f], ignore_index=True)
            made = []
            while len(held):
                n = int((held["pivot"] == held["pivot"].iloc[0]).to_numpy()[:size + 1].cumprod().sum())
                if n == len(held) and n <= size:
                    break  # the run may go on in the next frame
                made.append(block(held.iloc[:min(n, size)]))
                held = held.iloc[min(n, size):].reset_index(drop=True)
            if made:
                yield pd.DataFrame(made)
        if held is not None and len(held):
            yield pd.DataFrame([block(held)])
    return run


def _search(k: int, dims: int, top: float):
    """Pairs of a query block and an annulus -> the k best of the annulus for each query, by exact scores."""
    kind = float if top < DOUBLES else np.int64 if top < LONGS else object  # no score is larger than the largest square

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for q_ids, q_vecs, worst, ids, vecs in zip(f["q_ids"], f["q_vecs"], f["worst"], f["ids"], f["vecs"]):
                q_ids, ids = np.frombuffer(q_ids, np.int64), np.frombuffer(ids, np.int64)
                q = np.frombuffer(q_vecs, np.int64).reshape(-1, dims).astype(kind)
                x = np.frombuffer(vecs, np.int64).reshape(-1, dims).astype(kind)
                scores = q @ x.T
                # a place in falling order of score: ties, and Python integers, sort by their rank
                order_key = -np.unique(scores, return_inverse=True)[1].reshape(scores.shape) if kind is object else -scores
                out = q_ids[:, None] == ids[None, :]
                if worst is not None and not np.isnan(worst):
                    out |= scores.astype(float) < worst * (1 - np.sign(worst) * 1e-9) - 1
                order = np.lexsort((np.broadcast_to(ids, scores.shape), order_key, out), axis=1)[:, :k]
                r, c = np.nonzero(~np.take_along_axis(out, order, 1))
                if len(r):
                    best = scores[r, order[r, c]]
                    yield pd.DataFrame({"query_id": q_ids[r], "vec_id": ids[order[r, c]], "score": [str(int(b)) for b in best]})
    return run


def top_k(vectors: DataFrame, k: int = K, is_query=None, key: str = "vec_id", vec: str = "embedding", scale: int = SCALE,
          pivots: int = PIVOTS, ring: int = RING, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query with the other rows, exact.

    ``is_query`` is a condition on the column ``id``.
    """
    spark = vectors.sparkSession
    rows = Stored(integer_vectors(vectors, key, vec, scale), "vectors").df
    out = "query_id long, rank int, vec_id long, score decimal(38,0)"
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = rows.agg(F.max(square).alias("top"), F.max(F.size("vec")).alias("dims")).first()
    if facts["top"] is None:
        return spark.createDataFrame([], out)
    top, dims = float(facts["top"]) * (1 + 1e-9), max(1, facts["dims"])  # no less than the true square
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(pivots).toPandas()
    pivot_vecs = _matrix(chosen["vec"], dims)
    copies = Window.partitionBy("vec").orderBy("id")
    indexed = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).select("id", "vec")

    def blocked(df: DataFrame, size: int, queries: bool, name: str) -> DataFrame:
        keyed = df.mapInPandas(_assign(pivot_vecs, top, dims, queries), "id long, vec array<bigint>, pivot int, dist double")
        ordered = keyed.repartitionByRange("pivot", "dist", "id").sortWithinPartitions("pivot", "dist", "id")
        return Stored(ordered.mapInPandas(
            _blocks(size, dims, pivot_vecs, top, queries),
            "block long, pivot int, lo double, hi double, ids binary, vecs binary, los array<double>, his array<double>, norm double"), name).df

    annuli = blocked(indexed, ring, False, "annuli")
    asked = blocked(rows.where(is_query) if is_query is not None else rows, block, True, "query-blocks")
    directory = annuli.select("block", "pivot", "lo", "hi")
    # every block of queries with every pivot: its nearest and farthest distance to the pivot
    around = (asked.select(F.col("block").alias("q_block"), F.col("pivot").alias("own"), "norm", F.posexplode(F.arrays_zip("los", "his")).alias("pivot", "d"))
              .select("q_block", "own", "norm", "pivot", "d.los", "d.his"))
    return _expand(annuli, asked, directory, around, k, top, dims)


def _cells(lo, hi, first: float, width: float):
    """The cells of a distance range, as numbers from 0 to ``CELLS - 1``."""
    cell = lambda d: F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), F.floor((d - F.lit(first)) / F.lit(width)))).cast("int")
    return cell(lo), cell(hi)


def _neighbours(asked: DataFrame, directory: DataFrame) -> DataFrame:
    """(q_block, block): for each block of queries the last annulus of its own pivot that begins before it, and the next one.

    One window a pivot over the small rows of the directory, in order of distance.
    """
    none = F.lit(None).cast("bigint")
    own = asked.select(F.col("pivot"), F.col("lo").alias("at"), F.col("block").alias("q_block"), none.alias("block"))
    rings = directory.select("pivot", F.col("lo").alias("at"), none.alias("q_block"), "block")
    order = Window.partitionBy("pivot").orderBy("at", F.col("q_block").asc_nulls_first(), "block")
    before = F.last("block", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first("block", ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    near = own.unionByName(rings).select("q_block", F.array_compact(F.array(before, after)).alias("near")).where("q_block IS NOT NULL")
    return near.select("q_block", F.explode(F.array_distinct("near")).alias("block"))


def _expand(annuli, asked, directory, around, k, top, dims) -> DataFrame:
    def searched(pairs: DataFrame) -> DataFrame:
        asked_side = asked.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs"))
        joined = pairs.join(asked_side, "q_block").join(annuli.select("block", "ids", "vecs"), "block")
        return joined.select("q_block", "q_ids", "q_vecs", "worst", "ids", "vecs").mapInPandas(
            _search(k, dims, top), "query_id long, vec_id long, score string").withColumn("score", F.col("score").cast("decimal(38,0)"))

    first = Stored(searched(_neighbours(asked, directory).withColumn("worst", F.lit(None).cast("double"))), "first-search").df
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    queries = asked.select(F.col("block").alias("q_block"), F.explode(_ids("ids")).alias("query_id"))
    worst = queries.join(kth, "query_id", "left").groupBy("q_block").agg(
        F.when(F.count("kth") == F.count(F.lit(1)), F.min("kth")).cast("double").alias("worst"))
    # a score of at least ``worst`` allows no larger gap between distances to a pivot. Distances come from differences
    # of squares up to ``top``: their error grows with its root
    slack = 1e-3 + 1e-6 * top ** 0.5
    allowed = F.lit(slack) + F.sqrt(F.greatest(F.lit(0.0), F.col("norm") + F.lit(top * (1 + 2e-9) + 2) - 2 * F.col("worst")))
    reaching = around.join(worst, "q_block").withColumn("reach", F.when(F.col("worst").isNull(), F.lit(float("inf"))).otherwise(allowed))
    span = directory.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    width = max((span["hi"] - span["lo"]) / CELLS, 1e-9)
    # ranges meet in cells of distance; a pair counts in the first cell that both have
    from_cell, to_cell = _cells(F.col("los") - F.col("reach"), F.col("his") + F.col("reach"), span["lo"], width)
    asking = reaching.withColumns({"q0": from_cell, "q1": to_cell}).withColumn("cell", F.explode(F.sequence("q0", "q1")))
    from_cell, to_cell = _cells(F.col("lo"), F.col("hi"), span["lo"], width)
    rings = directory.withColumns({"a0": from_cell, "a1": to_cell}).withColumn("cell", F.explode(F.sequence("a0", "a1")))
    gap = F.greatest(F.lit(0.0), F.col("lo") - F.col("his"), F.col("los") - F.col("hi"))
    pairs = (asking.join(rings, ["pivot", "cell"]).where((F.col("cell") == F.greatest("q0", "a0")) & (gap <= F.col("reach")))
             .select("q_block", "block", "worst"))
    ranked = searched(pairs).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


@F.pandas_udf(T.ArrayType(T.LongType()))
def _ids(blobs: pd.Series) -> pd.Series:
    return blobs.map(lambda b: np.frombuffer(b, np.int64))


def query(spark, sf_dir) -> DataFrame:
    from sluice.llm.common import table
    found = top_k(table(spark, sf_dir, "embeddings"), is_query=F.col("id") % 50 == 0)
    return found.withColumn("score", F.col("score").try_cast("bigint"))


SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
