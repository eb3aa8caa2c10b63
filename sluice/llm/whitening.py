"""Operator 13, embedding whitening with a covariance recovered by polarisation.

Method. Entries become integers, and every distinct vector counts once. A first pass gives the number ``n`` of
vectors and the sums ``S`` of the dimensions. A second one aggregates exact squared centred values, of
``y = n*x - S``: per dimension ``sum(y_i**2)`` and per pair of dimensions ``sum((y_i + y_j)**2)``. Half the
difference of the variance of a sum and those of its parts is a covariance, which gives the whole matrix as
ratios of integers; ``eigh`` takes it apart on the driver. Rows are projected on the leading eigenvectors and
divided by the roots of their eigenvalues.

Exactness. Tasks square and add 64-bit integers, in digits of base 2**21 where a square needs more bits, and
Python integers where ``n*x`` itself does; Spark adds the digits as decimals.

Scale. Copies are merged before the shuffle of the distinct vectors; a task sends one row a pair of dimensions,
and the driver gets one row a pair (and digit), whatever the number of vectors: the bound is dimensions squared.

Defined results. Vectors that are null or hold null or non-finite entries take no part. An entry beyond the range
of a long counts as the nearest long. Shorter vectors count as padded with zeros. A null id stays null, repeated
rows give repeated rows. Components without variance (eigenvalue at most ``dimensions * 2**-52`` of the largest)
are not given, so vectors that are all equal, or a single one, give no rows; neither does an empty table. Equal
eigenvalues keep the order of ``eigh``; the largest entry of an eigenvector is positive. ``deviation`` is null
beyond 38 digits (beyond a long in the query).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Stored, bounded_batches, table

SCALE = 256
COMPONENTS = 4
#: Bits of a digit of a sum, rows squared at once, and such steps until a task sends what it has.
DIGIT = 21
STEP = 4096
FLUSH = 128


def integer_vectors(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, x): every usable row with ``floor(scale * entry)`` as longs."""
    finite = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    x = F.transform(vec, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("bigint"))
    return bounded_batches(vectors).where(F.col(vec).isNotNull() & finite).select(F.col(key).alias("id"), x.alias("x"))


def _padded(rows: DataFrame, dims: int) -> DataFrame:
    zeros = F.array_repeat(F.lit(0).cast("bigint"), F.greatest(F.lit(0), F.lit(dims) - F.size("x")))
    return rows.withColumn("x", F.slice(F.concat("x", zeros), 1, dims))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _widest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n*x - S``, exact: 64-bit integers where they fit with room for one addition, else Python integers."""
    if _widest(x) * n + max(map(abs, sums)) < 1 << 61:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _dimension_sums(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
        if n:
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(dims, dtype=np.int32)), "n": pa.array(np.full(dims, n)),
                                              "high": pa.array(high), "low": pa.array(low)})
    return run


class _Squares:
    """Exact sums of squares of every dimension (entry i, i) and of every pair's sum (entry i, j)."""

    def __init__(self, dims: int):
        self.i, self.j = np.triu_indices(dims)
        self.first = np.searchsorted(self.i, np.arange(dims + 1))
        self.clear()

    def clear(self) -> None:
        self.steps, self.digits = 0, np.zeros((5, len(self.i)), np.int64)
        self.wide: np.ndarray | None = None

    def add(self, y: np.ndarray) -> None:
        self.steps += 1
        bits = (2 * _widest(y)).bit_length()
        for i in range(y.shape[1]):
            z = y[:, i:] + y[:, i:i + 1]
            z[:, 0] = y[:, i]
            at = slice(self.first[i], self.first[i + 1])
            if y.dtype == object:
                if self.wide is None:
                    self.wide = np.zeros(len(self.i), object)
                self.wide[at] += (z * z).sum(0)
            elif 2 * bits + len(y).bit_length() <= 63:
                s = np.einsum("ij,ij->j", z, z)
                self.digits[0, at] += s & ((1 << 2 * DIGIT) - 1)
                self.digits[2, at] += s >> 2 * DIGIT
            else:
                a, b, c = z >> 2 * DIGIT, (z >> DIGIT) & ((1 << DIGIT) - 1), z & ((1 << DIGIT) - 1)
                dot = [np.einsum("ij,ij->j", u, v) for u, v in ((c, c), (b, c), (a, c), (b, b), (a, b), (a, a))]
                self.digits[:, at] += np.stack([dot[0], 2 * dot[1], 2 * dot[2] + dot[3], 2 * dot[4], dot[5]])

    def batch(self) -> pa.RecordBatch:
        k, at = np.nonzero(self.digits)
        value = self.digits[k, at]
        if self.wide is not None:
            parts, rest, power = [], self.wide, 0
            while any(rest):
                parts.append((np.full(len(rest), power), np.arange(len(rest)), (rest & ((1 << DIGIT) - 1)).astype(np.int64)))
                rest, power = rest >> DIGIT, power + 1
            k, at, value = (np.concatenate(c) for c in zip((k, at, value), *parts))
        self.clear()
        return pa.RecordBatch.from_pydict({"i": pa.array(self.i[at].astype(np.int32)), "j": pa.array(self.j[at].astype(np.int32)),
                                           "k": pa.array(k.astype(np.int32)), "v": pa.array(value)})


def _pair_squares(dims: int, n: int, sums: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares = _Squares(dims)
        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            for at in range(0, len(x), STEP):
                squares.add(_centred(x[at:at + STEP], n, sums))
                if squares.steps == FLUSH:
                    yield squares.batch()
        if squares.steps:
            yield squares.batch()
    return run


@dataclass
class Whitening:
    """A fitted whitening: centre ``sums / n``, eigenvectors (columns) and eigenvalues in falling order."""

    dims: int
    n: int
    sums: list[int]
    covariance: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    def apply(self, rows: DataFrame) -> DataFrame:
        """(id, deviation, whitened): decimal(38,0) and one double a component for each row of ``integer_vectors``."""
        dims, n, sums = self.dims, self.n, self.sums
        projection = self.vectors / np.sqrt(self.values)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                y = _centred(_matrix(batch.column("x"), dims), n, sums)
                wide = 2 * _widest(y).bit_length() + dims.bit_length() > 63
                deviation = (y.astype(object) ** 2).sum(1) if wide else np.einsum("ij,ij->i", y, y)
                whitened = (y / n).astype(float) @ projection
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column("id"), "deviation": pa.array([str(d) for d in deviation], pa.string()),
                    "whitened": pa.ListArray.from_arrays(np.arange(0, whitened.size + 1, whitened.shape[1], np.int32), whitened.ravel())})

        kind = rows.schema["id"].dataType.simpleString()
        done = _padded(rows, dims).mapInArrow(run, f"id {kind}, deviation string, whitened array<double>")
        return done.withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)"))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of ``integer_vectors``; None if there is none to fit."""
    dims = rows.agg(F.max(F.size("x"))).first()[0]
    if not dims:
        return None
    kept = Stored(_padded(rows, dims).select("x").distinct(), "distinct-vectors")
    sums = (kept.df.mapInArrow(_dimension_sums(dims), "i int, n long, high long, low long").groupBy("i")
            .agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("n", "high", "low")]).orderBy("i").collect())
    n, total = int(sums[0]["n"]), [(int(r["high"]) << 32) + int(r["low"]) for r in sums]
    squared = kept.df.mapInArrow(_pair_squares(dims, n, total), "i int, j int, k int, v long")
    square = np.zeros((dims, dims), object)
    for r in squared.groupBy("i", "j", "k").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("v")).collect():
        square[r["i"], r["j"]] += int(r["v"]) << (DIGIT * r["k"])
    own, cube = [square[i, i] for i in range(dims)], n ** 3
    covariance = np.zeros((dims, dims))
    for i in range(dims):
        covariance[i, i] = own[i] / cube
        for j in range(i + 1, dims):  # var(x_i + x_j) = var(x_i) + var(x_j) + 2 cov(x_i, x_j)
            covariance[i, j] = covariance[j, i] = (square[i, j] - own[i] - own[j]) / (2 * cube)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = int((values > dims * 2.0 ** -52 * values[0]).sum()) if values[0] > 0 else 0
    if not rank:
        kept.drop()
        return None
    values, vectors = values[:min(rank, components)], vectors[:, :min(rank, components)]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    model = Whitening(dims, n, total, covariance, vectors, values, sum(own) / cube)
    model.identity_error = _identity_error(model, kept.df)
    kept.drop()
    return model


def _identity_error(model: Whitening, distinct: DataFrame) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity."""
    white = model.apply(distinct.select(F.lit(None).cast("bigint").alias("id"), "x"))
    k = len(model.values)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = white.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vec: str = "embedding", scale: int = SCALE) -> DataFrame:
    """A row per usable vector and component: (key, component, n, deviation, whitened, explained, identity_error)."""
    rows = integer_vectors(vectors, key, vec, scale)
    model = fit(rows, components)
    names = {"id": key}
    if model is None:
        kind = rows.schema["id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame(
            [], f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return (model.apply(rows).select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
                    explained[F.col("at")].alias("explained"), F.lit(float(model.identity_error)).alias("identity_error"))
            .withColumnsRenamed(names))


def query(spark, sf_dir) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("bigint"))
