"""Regression trees on histograms, grown level by level by grouped aggregates with exact arithmetic.

Features are whole-numbered bins. One aggregate a level counts rows and sums labels per
(tree, node, feature, bin), combined on the map side, so what is shuffled depends on trees
and bins and not on rows. The best split of a node is the one with the largest
``sl**2 / nl + sr**2 / nr``, ties to the first feature and the lowest bin. A tree's
sample is drawn by a hash of the row's key. Counts and sums are integers, and predictions
are rounded to millionths from ratios of them: any engine that adds up the same rows
finds the same splits, predictions and errors, in any order.

The driver holds the splits (at most ``2**depth`` a tree); a row finds its leaf by a
projection.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.numeric import round_ratio
from sluice.operators.seed import unit_draw
from sluice.session import written_table

UNITS = 1_000_000
#: Share of the training rows in a tree's sample, when there are several trees.
SAMPLE = 0.632


@dataclass(frozen=True)
class ForestConfig:
    """``widths`` are the bins of features that are not small whole numbers."""

    features: tuple[str, ...]
    n_trees: int = 5
    max_depth: int = 4
    min_leaf: int = 5
    seed: int = 42
    max_acceptable_mae: float = 12.0
    widths: dict[str, float] = field(default_factory=dict)

    def salt(self, tree: int) -> int:
        return self.seed * 1000 + tree


@dataclass
class Tree:
    """Node ``i`` has the children ``2i`` and ``2i + 1``; feature 0 marks a leaf, else bins above ``bound`` go right."""

    depth: int
    feature: list[int]
    bound: list[int]
    value: list[int]

    @classmethod
    def root(cls, depth: int) -> Tree:
        size = 2 ** (depth + 1)
        return cls(depth, [0] * size, [0] * size, [0] * size)

    def leaf(self, x: Column) -> Column:
        """The leaf of a row with bins ``x``."""
        feature, bound = _literal(self.feature), _literal(self.bound)

        def down(node: Column, _: Column) -> Column:
            f = feature[node]
            right = F.element_at(x, F.greatest(f, F.lit(1))) > bound[node]
            return F.when(f == 0, node).otherwise(node * 2 + right.cast("int"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, self.depth))), F.lit(1), down)


def _literal(numbers: list[int]) -> Column:
    return F.array(*[F.lit(n) for n in numbers])


def bins(cfg: ForestConfig) -> Column:
    """The features as an array of whole-numbered bins."""
    return F.array(*[F.floor(F.col(f) / F.lit(cfg.widths[f])).cast("int") if f in cfg.widths else F.col(f).cast("int") for f in cfg.features])


def _in_sample(cfg: ForestConfig, tree: int) -> Column:
    return unit_draw(F.col("k"), cfg.salt(tree)) < SAMPLE if cfg.n_trees > 1 else F.lit(True)


def grow(train: DataFrame, cfg: ForestConfig) -> list[Tree]:
    """Trees over rows (k, x, y): key, bins and whole-numbered label."""
    trees = [Tree.root(cfg.max_depth) for _ in range(cfg.n_trees)]

    def placed() -> DataFrame:
        """A row per row and tree whose sample it is in, with its node of the trees as far as they are grown."""
        nodes = F.array(*[F.when(_in_sample(cfg, i), t.leaf(F.col("x"))) for i, t in enumerate(trees)])
        return train.select("x", "y", F.posexplode(nodes).alias("tree", "node")).where(F.col("node").isNotNull())

    for level in range(cfg.max_depth):
        hist = (placed().where(F.col("node") >= 2 ** level).select("tree", "node", "y", F.posexplode("x").alias("f", "bin"))
                .groupBy("tree", "node", "f", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")))
        best = best_splits(hist, cfg.min_leaf).collect()  # at most one row a node of the level
        for r in best:
            trees[r["tree"]].feature[r["node"]], trees[r["tree"]].bound[r["node"]] = r["f"] + 1, r["bin"]
        if not best:
            break
    for r in placed().groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")).collect():  # one row a leaf
        trees[r["tree"]].value[r["node"]] = (2 * r["s"] * UNITS + r["n"]) // (2 * r["n"])
    return trees


def best_splits(hist: DataFrame, min_leaf: int) -> DataFrame:
    """(tree, node, f, bin): of each node's histogram the split that lowers the squared error most, if any does."""
    of = Window.partitionBy("tree", "node", "f")
    upto = of.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    cut = hist.select("tree", "node", "f", "bin", F.sum("n").over(upto).alias("nl"), F.sum("s").over(upto).alias("sl"),
                      F.sum("n").over(of).alias("n"), F.sum("s").over(of).alias("s"))

    def part(s: Column, n: Column) -> Column:
        return s.cast("double") * s.cast("double") / n.cast("double")

    nr, sr = F.col("n") - F.col("nl"), F.col("s") - F.col("sl")
    scored = cut.where((F.col("nl") >= min_leaf) & (nr >= min_leaf)).withColumn("score", part(F.col("sl"), F.col("nl")) + part(sr, nr))
    better = scored.where(F.col("score") > part(F.col("s"), F.col("n")))
    return better.groupBy("tree", "node").agg(F.max_by(F.struct("f", "bin"), F.struct("score", -F.col("f"), -F.col("bin"))).alias("_b")).select(
        "tree", "node", "_b.f", "_b.bin")


def predict(rows: DataFrame, trees: list[Tree]) -> DataFrame:
    """Add ``prediction_e6``: the trees' mean of leaf means, in millionths, for labels that are not negative."""
    total = sum((_literal(t.value)[t.leaf(F.col("x"))].cast("bigint") for t in trees), F.lit(0).cast("bigint"))
    twice = total * 2 + len(trees)
    return rows.withColumn("prediction_e6", ((twice - F.pmod(twice, F.lit(2 * len(trees)))) / (2 * len(trees))).cast("bigint"))


def fit_and_predict(split: DataFrame, cfg: ForestConfig, key: Column, label: str = "sales") -> tuple[list[Tree], DataFrame]:
    """Trees of the rows with ``split`` = train, and the predictions of the others: (k, x, y, prediction_e6)."""
    rows = split.select(key.cast("bigint").alias("k"), bins(cfg).alias("x"), F.col(label).cast("bigint").alias("y"), "split")
    kept = written_table(rows, "forest-rows")  # every level reads the rows again
    trees = grow(kept.where("split = 'train'"), cfg)
    return trees, predict(kept.where("split <> 'train'"), trees)


def mean_error(predicted: DataFrame) -> DataFrame:
    """(n_test, mae): the mean absolute error, rounded from whole millionths."""
    off = F.abs(F.col("y") * UNITS - F.col("prediction_e6")).cast("decimal(38,0)")
    agg = predicted.agg(F.sum(off).alias("e"), F.count(F.lit(1)).alias("n_test"))
    return agg.select("n_test", F.when(F.col("n_test") > 0, round_ratio("e", F.col("n_test") * UNITS, 4)).alias("mae"))
