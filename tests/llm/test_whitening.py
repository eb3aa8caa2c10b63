"""Operator 13 against a plain computation in exact fractions and numpy."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from helpers import clashing

from sluice.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>"


def brute(vectors):
    """(n, sums, exact covariance as fractions) over the distinct integer vectors."""
    dims = max(map(len, vectors))
    x = {tuple(math.floor(256 * c) for c in v) + (0,) * (dims - len(v)) for v in vectors}
    n, sums = len(x), [sum(v[d] for v in x) for d in range(dims)]
    mean = [Fraction(s, n) for s in sums]
    cov = [[sum((v[i] - mean[i]) * (v[j] - mean[j]) for v in x) / n for j in range(dims)] for i in range(dims)]
    return n, sums, cov


def check(spark, data, components=4):
    rows = spark.createDataFrame(data, SCHEMA)
    usable = [(i, v) for i, v in data if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, sums, cov = brute([v for _, v in usable])
    dims = len(sums)
    model = W.fit(W.integer_vectors(rows), components)
    assert (model.n, model.sums) == (n, sums)
    exact = np.array([[float(c) for c in r] for r in cov])
    assert np.array_equal(model.covariance, exact)  # ratios of integers, rounded once
    values = np.linalg.eigvalsh(exact)[::-1]
    out = W.whiten(rows, components).collect()
    kept = len(model.values)
    assert len(out) == len(usable) * kept
    assert {r["component"] for r in out} == set(range(1, kept + 1))
    by_id = {}
    for r in out:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
        assert r["n"] == n and r["identity_error"] <= 1e-4
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(exact), rel=1e-9)
    for i, v in usable:
        x = [math.floor(256 * c) for c in v] + [0] * (dims - len(v))
        y = [n * a - s for a, s in zip(x, sums)]
        for c, r in by_id[i].items():
            assert int(r["deviation"]) == sum(a * a for a in y)
            want = sum(a / n * model.vectors[d, c - 1] for d, a in enumerate(y)) / math.sqrt(model.values[c - 1])
            assert r["whitened"] == pytest.approx(want, rel=1e-9, abs=1e-9)
    return model


def test_against_fractions(spark, rng):
    data = [(i, [rng.gauss(0, 1 + d) + (0.5 * i % 3) for d in range(6)]) for i in range(60)]
    data += [(100, data[0][1]), (100, data[0][1]), (None, data[1][1])]  # repeated rows, a null id
    data += [(200, None), (201, [None] * 6), (202, [float("nan")] + [0.0] * 5), (203, [float("-inf")] + [0.0] * 5), (204, [])]
    data += [(205, [1.0, -0.0])]  # padded with zeros
    check(spark, data)


@pytest.mark.parametrize("size", [1e3, 1e9, 1e14])
def test_large_entries_are_exact(spark, rng, size):
    # 64-bit squares, squares in digits, and Python integers
    check(spark, [(i, [rng.uniform(-size, size) for _ in range(4)]) for i in range(40)])


def test_entries_beyond_a_long_do_not_fail(spark):
    rows = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 1.0])], SCHEMA)
    out = W.whiten(rows).collect()
    assert len(out) == 3 * max(r["component"] for r in out)
    assert all(math.isfinite(r["whitened"]) for r in out)


def test_no_variance_and_empty(spark):
    for data in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert W.whiten(spark.createDataFrame(data, SCHEMA)).collect() == []
    # two distinct vectors have one component
    assert {r["component"] for r in W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 9.0])], SCHEMA)).collect()} == {1}


def test_extra_columns_and_float_entries(spark, rng):
    rows = spark.createDataFrame([(i, [rng.random() for _ in range(5)]) for i in range(30)], "vec_id long, embedding array<float>")
    extra = clashing(rows).withColumns({"id": rows.vec_id + 1, "x": rows.embedding, "component": rows.vec_id})
    a, b = (sorted(map(tuple, W.whiten(df).collect())) for df in (rows, extra))
    assert [r[:4] for r in a] == [r[:4] for r in b]
    assert np.allclose([r[4] for r in a], [r[4] for r in b], atol=1e-12)


def test_sums_of_many_steps(spark, rng, monkeypatch):
    monkeypatch.setattr(W, "STEP", 7)
    monkeypatch.setattr(W, "FLUSH", 3)
    check(spark, [(i, [rng.gauss(0, 50) for _ in range(3)]) for i in range(200)])
