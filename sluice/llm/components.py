"""Connected components of an undirected edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the least of the node and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.least("u", "m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return (joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .where("a <> b").distinct())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the label is the component's least node.

    Joins are on nodes, so a hub is a skewed key that adaptive execution splits; sums run on the map side.
    """
    mark = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")]
    now = Stored(edges.where("a <> b").select("a", "b").distinct(), f"{name}-edges")
    before = None
    while True:
        then = Stored(_small_star(_large_star(now.df)), f"{name}-round")
        now.drop()
        now, seen = then, tuple(then.df.agg(*mark).first())
        if seen == before:
            break
        before = seen
    stars = now.df.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.unionByName(now.df.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
