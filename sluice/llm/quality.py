"""Operator 8, quality classifier: a sparse ensemble of rules over text statistics.

Method. Statistics of every whole text (shares of letter cases, digits, punctuation and lines, repetition of
words and lines) are computed per batch. A random forest of shallow trees is fitted on at most
``sample`` labelled documents, taken by the hash of their ids; every path from a root to any node below it
is a rule, a conjunction of threshold conditions. An L1-penalised logistic regression weighs the rules; those
with a weight are compiled into one Spark column expression over the statistics, which scores all documents
without a shuffle.

Defined results. Null or empty text: all statistics are 0 and the text is scored like any other. Labels other
than 0 and 1 are not learned from; a document labelled several times counts as often. With labels of one
kind only the score is that label, with none at all 1. A null doc_id counts as the empty id when rows are
held out and meets no label. Repeated rows give repeated rows, and are learned from as often. An empty table gives no
rows. Columns are found by the names ``doc_id``, ``text`` and ``quality`` only. Texts of any length are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import Stored, bounded_batches, doc_id, public_id

THRESHOLD = 0.7
#: Labelled documents that are learned from, at most.
SAMPLE = 8000
TREES = 24
DEPTH = 3
PENALTY = 1e-3
#: Shares only: neither the length of a text nor that of its words says how good it is.
STATISTICS = ("upper", "lower", "digit", "space", "punct", "symbol", "letters", "distinct_words", "top_word", "repeat_next",
              "distinct_lines", "bare_punct", "sentence_end", "capital_words")
_CLASSES = 7  # other, upper, lower, other letter, digit, space, punctuation; symbols are the rest of ASCII
_CHUNK = 1 << 20


@lru_cache(1)
def _class_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x30000):
        ch = chr(c)
        table[c] = (1 if ch.isupper() else 2 if ch.islower() else 3 if ch.isalpha() else 4 if ch.isdigit() else 5 if ch.isspace()
                    else 6 if ch in ".,;:!?'\"()-" else 0)
    return table


def _word_statistics(text: str) -> tuple[float, ...]:
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * 7
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    bare = sum(v for w, v in counts.items() if not any(map(str.isalnum, w)))
    ends = sum(v for w, v in counts.items() if w[-1] in ".!?")
    capital = sum(v for w, v in counts.items() if w[0].isupper())
    nexts = sum(map(str.__eq__, words, words[1:]))
    return (len(counts) / n, max(counts.values()) / n, nexts / n, len(set(lines)) / len(lines), bare / n, ends / n, capital / n)


def statistics(texts: list[str]) -> np.ndarray:
    """One row of ``STATISTICS`` per text."""
    n = len(texts)
    counts = np.zeros((n, _CLASSES))
    table = _class_table()
    for i, text in enumerate(texts):
        for lo in range(0, len(text), _CHUNK):
            points = np.frombuffer(text[lo:lo + _CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
            counts[i] += np.bincount(table[points], minlength=_CLASSES)
    chars = counts.sum(1)
    share = counts / np.maximum(chars, 1)[:, None]
    letters = share[:, 1] + share[:, 2] + share[:, 3]
    by_word = np.array(list(map(_word_statistics, texts))).reshape(n, 7)
    return np.column_stack([share[:, [1, 2, 4, 5, 6, 0]], letters, by_word])  # in the order of STATISTICS


def with_statistics(rows: DataFrame, keep: list[str], types: str) -> DataFrame:
    """``keep`` columns (``types`` is their DDL) and a double column ``stat_<name>`` per statistic; rows have ``text``."""
    names = [f"stat_{s}" for s in STATISTICS]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            stats = pd.DataFrame(statistics(list(f["text"])), columns=names, index=f.index)
            yield pd.concat([f[keep], stats], axis=1)
    return bounded_batches(rows).select(*keep, "text").mapInPandas(run, types + "".join(f", {n} double" for n in names))


class Rule(NamedTuple):
    """All of (statistic number, is above, threshold) hold."""
    conditions: tuple[tuple[int, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for k, above, threshold in self.conditions:
            c = F.col(f"stat_{STATISTICS[k]}")
            out = out & (c > F.lit(threshold) if above else c <= F.lit(threshold))
        return out


_NODE = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def rules_of(forest) -> list[Rule]:
    """Every path of every tree, redundant conditions left out, each once."""
    found: dict[Rule, None] = {}
    for tree in forest.trees:
        path: list[tuple[int, bool, float]] = []
        depths: list[int] = []
        for line in tree.toDebugString.splitlines():
            m = _NODE.match(line)
            if not m:
                continue
            while depths and depths[-1] >= len(m[1]):
                depths.pop()
                path.pop()
            depths.append(len(m[1]))
            path.append((int(m[2]), m[3] == ">", float(m[4])))
            tight: dict[tuple[int, bool], float] = {}
            for k, above, t in path:
                tight[k, above] = (max if above else min)(t, tight.get((k, above), t))
            found[Rule(tuple(sorted((k, a, t) for (k, a), t in tight.items())))] = None
    return list(found)


class Ensemble(NamedTuple):
    rules: list[Rule]
    weights: list[float]
    intercept: float

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH,
        penalty: float = PENALTY) -> Ensemble:
    """``documents`` (doc_id, text); ``labels`` (doc_id, quality) of the rows that may be learned from."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("double").alias("label"))
    picked = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)  # bounded: broadcast
    joined = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    rows = Stored(with_statistics(joined, ["label"], "label double"), "quality-sample").df
    kinds = [r["label"] for r in rows.select("label").distinct().collect()]
    if len(kinds) < 2:
        return Ensemble([], [], 50.0 if kinds in ([], [1.0]) else -50.0)
    features = array_to_vector(F.array(*[F.col(f"stat_{s}") for s in STATISTICS])).alias("features")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", seed=7).fit(rows.select("label", features))
    rules = rules_of(forest)
    if not rules:
        share = rows.agg(F.avg("label")).first()[0]
        return Ensemble([], [], float(np.log(share / (1 - share))))
    fires = array_to_vector(F.array(*[r.column().cast("double") for r in rules])).alias("features")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=False).fit(rows.select("label", fires))
    kept = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w]
    return Ensemble([r for r, _ in kept], [w for _, w in kept], float(lasso.intercept))


def scored(documents: DataFrame, ensemble: Ensemble, keep: list[str], types: str, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns, score and predicted for every row of ``documents``, which has text without nulls."""
    out = with_statistics(documents, keep, types).withColumn("score", ensemble.score())
    return out.select(*keep, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(rows: DataFrame, ensemble: Ensemble, schema: T.StructType, threshold: float = THRESHOLD) -> DataFrame:
    """``rows`` (row, text) whose score reaches the threshold; the statistics are an array beside the untouched row."""
    stats = bounded_batches(rows).withColumn("stats", _statistics_udf("text"))
    named = stats.select("row", *[F.col("stats")[i].alias(f"stat_{s}") for i, s in enumerate(STATISTICS)])
    return named.where(ensemble.score() >= threshold).select("row")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics_udf(text: pd.Series) -> pd.Series:
    return pd.Series(list(statistics(list(text))))


def held_out(column: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % 4 == 2


def classify(documents: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """(doc_id, held_out, score, predicted); held-out rows' labels are not learned from."""
    ensemble = fit(documents, labels.where(~held_out()), **settings)
    docs = documents.select(doc_id().alias("doc_id"), held_out().alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return scored(docs, ensemble, ["doc_id", "held_out"], "doc_id long, held_out boolean").withColumn("doc_id", public_id("doc_id"))


def query(spark, sf_dir) -> DataFrame:
    from sluice.llm.common import table
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
