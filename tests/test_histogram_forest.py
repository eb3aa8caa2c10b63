"""The exact forest against growing the same trees row by row."""

from __future__ import annotations

import random
from fractions import Fraction

from pyspark.sql import functions as F

from sluice.operators import histogram_forest as HF

ROWS = "k long, split string, a int, b double, y long"


def data(n, seed=3):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        a, b = rng.randrange(6), rng.choice([0.1, 0.9, 1.7, 2.2, 9.0])
        out.append((k, "test" if k % 5 == 0 else "train", a, b, max(0, 10 * (a > 2) + 7 * (b > 1) * (a < 2) + rng.randrange(4))))
    return out


def by_hand(rows, cfg, bags):
    """Predictions by exhaustive search over splits, with exact fractions."""
    x = {r[0]: (r[2], int(r[3] // 0.5)) for r in rows}
    y = {r[0]: r[4] for r in rows}

    def score(keys):
        return Fraction(sum(y[k] for k in keys) ** 2, len(keys)) if keys else Fraction(0)

    def value(keys, probe, depth):
        best = None
        for f in range(2):
            for cut in sorted({x[k][f] for k in keys}):
                left, right = [k for k in keys if x[k][f] <= cut], [k for k in keys if x[k][f] > cut]
                if min(len(left), len(right)) >= cfg.min_leaf:
                    s = score(left) + score(right)
                    if s > score(keys) and (best is None or s > best[0]):
                        best = (s, f, cut, left, right)
        if depth == cfg.max_depth or best is None:
            s, n = sum(y[k] for k in keys), len(keys)
            return (2 * s * 10 ** 6 + n) // (2 * n)
        return value(best[3] if x[probe][best[1]] <= best[2] else best[4], probe, depth + 1)

    test = [r[0] for r in rows if r[1] == "test"]
    out = {}
    for probe in test:
        total = sum(value(bag, probe, 0) for bag in bags)
        out[probe] = (2 * total + len(bags)) // (2 * len(bags))
    return out


def test_trees_equal_exhaustive_search(spark):
    rows = data(240)
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    for cfg in (HF.ForestConfig(("a", "b"), 1, 3, 5, widths={"b": 0.5}), HF.ForestConfig(("a", "b"), 3, 2, 9, widths={"b": 0.5})):
        trees, predicted = HF.fit_and_predict(df, cfg, F.col("k"), "y")
        drawn = spark.createDataFrame(rows, ROWS).where("split = 'train'").select("k", *[HF._in_sample(cfg, t).alias(f"t{t}") for t in range(cfg.n_trees)]).collect()
        bags = [[r.k for r in drawn if r[f"t{t}"]] for t in range(cfg.n_trees)]
        assert {r.k: r.prediction_e6 for r in predicted.collect()} == by_hand(rows, cfg, bags)
        assert len(trees) == cfg.n_trees


def test_error_is_exact_and_order_does_not_matter(spark):
    cfg = HF.ForestConfig(("a", "b"), 3, 3, 4, widths={"b": 0.5})
    results = []
    for parts in (1, 7):
        _, predicted = HF.fit_and_predict(spark.createDataFrame(data(300, 9), ROWS).repartition(parts), cfg, F.col("k"), "y")
        results.append((sorted((r.k, r.prediction_e6) for r in predicted.collect()), HF.mean_error(predicted).first()))
    assert results[0] == results[1]
    rows = {r[0]: r[4] for r in data(300, 9)}
    want = sum(abs(rows[k] * 10 ** 6 - p) for k, p in results[0][0]) / len(results[0][0]) / 10 ** 6
    assert abs(results[0][1].mae - want) <= 5.1e-5


def test_nothing_to_split(spark):
    """Equal labels, too few rows, one row: the root's mean is the prediction."""
    cfg = HF.ForestConfig(("a", "b"), 1, 3, 5, widths={"b": 0.5})
    for train in ([(i, "train", i, 1.0, 4) for i in range(50)], [(i, "train", i, 1.0, i) for i in range(1, 8)], [(1, "train", 1, 1.0, 4)]):
        _, predicted = HF.fit_and_predict(spark.createDataFrame([*train, (99, "test", 3, 5.0, 4)], ROWS), cfg, F.col("k"), "y")
        assert [(r.k, r.prediction_e6) for r in predicted.collect()] == [(99, 4_000_000)]
