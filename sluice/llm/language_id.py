"""Operator 4, language ID by hierarchical discrimination with linear support vector machines.

Method. A text is a bag of hashed letter pairs and triples (case folded, everything but letters is one
space), as shares of the text. One-versus-rest SVMs predict the language family; within a family, one SVM
for each pair of its languages votes, ties by the sum of margins. ``pyspark.ml.LinearSVC`` fits them on at
most ``per_language`` documents of each language, taken by the hash of their ids; the whole text of every
document is scored in one pass, without a shuffle.

Families are the usual ones of known codes; an unknown code is a family of its own.

Defined results. ``und`` with score 0: text null or without a letter, or nothing to learn from. With one
language learned, every text with a letter is that language, score 1. Rows with a null lang are predicted
but not learned from. A null doc_id counts as the empty id when rows are held out. Repeated rows give
repeated rows, and are learned from once. An empty table gives no rows, columns with other names are ignored.
Texts of any length are read whole, one after the other (some 60 bytes of memory a character of the longest).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import Stored, bounded_batches, doc_id, public_id

UNDETERMINED = "und"
#: Documents of a language that are learned from, at most.
PER_LANGUAGE = 1000
DIMS = 1 << 14
SCALE = 30.0  # a text's vector has a length of about 1
CHUNK_CHARS = 1 << 20
# Language codes by family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"), "uralic": ("et", "fi", "hu"), "turkic": ("az", "kk", "tr", "uz"), "celtic": ("cy", "ga", "gd"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"), "semitic": ("ar", "he", "mt"),
}


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang.lower().split("-")[0] in codes), f"={lang}")


@lru_cache(1)
def _fold() -> np.ndarray:
    """Code point -> lower-case letter, or a space for all that is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def gram_ids(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of pairs and triples, text of each, letters per text); texts never share a gram."""
    gap = "\n\n\n"  # before each text, so that no gram spans two
    joined = gap + gap.join(texts) + gap
    c = _fold()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.append(np.repeat(np.arange(len(texts)), lengths + 3), [len(texts) - 1] * 3)
    letters = np.bincount(owner[c != 32], minlength=len(texts))
    c = c.astype(np.uint64)
    keep = np.flatnonzero((c[:-2] != 32) | (c[1:-1] != 32))  # grams within or at the edge of a word
    a, b, d = c[keep], c[keep + 1], c[keep + 2]
    pair = (a * np.uint64(0x9E3779B1) + b * np.uint64(0x85EBCA77)) * np.uint64(0xC2B2AE3D27D4EB4F)
    triple = (pair + d * np.uint64(0x27D4EB2F165667C5)) * np.uint64(0x9E3779B97F4A7C15)
    shift = np.uint64(64 - (DIMS.bit_length() - 1))
    return np.stack([pair >> shift, triple >> shift], 1).astype(np.int64), owner[keep], letters


def vector(text: str) -> SparseVector:
    ids, _, letters = gram_ids([text])
    counts = np.bincount(ids.ravel(), minlength=DIMS)
    at = np.flatnonzero(counts)
    return SparseVector(DIMS, at.tolist(), (SCALE * counts[at] / max(1, ids.size)).tolist())


class Model:
    """Weights of all machines side by side: families first, then pairs of languages."""

    def __init__(self, langs: list[str]):
        self.langs = sorted(langs)
        self.families = sorted({family_of(x) for x in self.langs})
        self.members = [[i for i, x in enumerate(self.langs) if family_of(x) == f] for f in self.families]
        self.pairs = [(i, j) for m in self.members for i in m for j in m if i < j]
        self.weights, self.bias = np.zeros((DIMS, 0)), np.zeros(0)

    def add(self, coefficients, intercept: float) -> None:
        self.weights = np.column_stack([self.weights, coefficients])
        self.bias = np.append(self.bias, intercept)

    def margins(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, owner, letters = gram_ids(texts)
        sums = np.zeros((len(texts), len(self.bias)))
        weights = self.weights.astype(np.float32)
        edges = np.searchsorted(owner, np.arange(len(texts) + 1))
        for lo in range(0, len(ids), CHUNK_CHARS):  # bounds memory on long texts
            part, own = ids[lo:lo + CHUNK_CHARS], owner[lo:lo + CHUNK_CHARS]
            if not len(self.bias):
                break
            both = weights[part[:, 0]] + weights[part[:, 1]]
            head = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            np.add.at(sums, own[head], np.add.reduceat(both, head, dtype=np.float64))
        return SCALE * sums / np.maximum(2 * np.diff(edges), 1)[:, None] + self.bias, letters

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        margins, letters = self.margins(texts)
        sure = lambda m: 1 / (1 + np.exp(-np.clip(2 * m, -50, 50)))
        n_family = len(self.families) if len(self.families) > 1 else 0
        family = margins[:, :n_family].argmax(1) if n_family else np.zeros(len(texts), int)
        score = sure(margins[np.arange(len(texts)), family]) if n_family else np.ones(len(texts))
        votes, strength = np.zeros((len(texts), len(self.langs))), np.zeros((len(texts), len(self.langs)))
        for k, (i, j) in enumerate(self.pairs):
            m = margins[:, n_family + k]  # positive: j
            votes[:, j] += m > 0
            votes[:, i] += m <= 0
            strength[:, j] += np.tanh(m)
            strength[:, i] -= np.tanh(m)
        inside = np.full((len(self.families), len(self.langs)), -np.inf)
        for f, members in enumerate(self.members):
            inside[f, members] = 0
        best = (votes + strength / (2 * len(self.langs)) + inside[family]).argmax(1)
        for k, (i, j) in enumerate(self.pairs):
            m = margins[:, n_family + k]
            score = np.where(best == j, np.minimum(score, sure(m)), np.where(best == i, np.minimum(score, sure(-m)), score))
        langs = [self.langs[b] if n else UNDETERMINED for b, n in zip(best.tolist(), letters.tolist())]
        return langs, np.where(letters > 0, score, 0.0)


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, iterations: int = 12) -> Model:
    """``labelled`` has doc_id, text, lang."""
    by_hash = Window.partitionBy("lang").orderBy("h", "doc_id", "tv")
    # only keys go through the window; the picked ones, a bounded number, fetch their texts where these are read
    keyed = labelled.select("doc_id", "lang", "text", F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("tv"))
    usable = keyed.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "doc_id", "h", "tv").distinct()
    picked = usable.withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= per_language).select("lang", "doc_id", "tv")
    # copies of a picked row are merged where they are read: the sample keeps its bound
    rows = keyed.join(F.broadcast(picked), ["lang", "doc_id", "tv"]).groupBy("lang", "doc_id", "tv").agg(F.first("text").alias("text"))
    sample = Stored(rows.select("lang", F.udf(vector, VectorUDT())("text").alias("features")), "language-sample").df
    model = Model([r["lang"] for r in sample.select("lang").distinct().collect()])
    svm = LinearSVC(maxIter=iterations, regParam=1e-4, standardization=False)

    def machine(rows: DataFrame, positive: list[str]) -> None:
        fitted = svm.fit(rows.withColumn("label", F.col("lang").isin(positive).cast("double")))
        model.add(fitted.coefficients.toArray(), fitted.intercept)

    if len(model.families) > 1:
        for members in model.members:
            machine(sample, [model.langs[i] for i in members])
    for i, j in model.pairs:
        machine(sample.where(F.col("lang").isin(model.langs[i], model.langs[j])), [model.langs[j]])
    return model


def _predict(model: Model):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            langs, scores, batch, size = [], [], [], 0
            for i, text in enumerate(f["text"]):
                batch.append(text)
                size += len(text)
                if size > CHUNK_CHARS or i == len(f) - 1:
                    found, score = model.predict(batch)
                    langs += found
                    scores.append(score)
                    batch, size = [], 0
            yield pd.DataFrame({"doc_id": f["doc_id"], "held_out": f["held_out"], "lang_pred": langs,
                                "score": np.concatenate(scores) if scores else []})
    return run


def identify(documents: DataFrame, held_out, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; learns from rows where ``held_out`` is false."""
    docs = bounded_batches(documents).select(doc_id().alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                            F.col("lang").cast("string").alias("lang"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    model = fit(docs.where(~F.col("held_out")), per_language)
    found = docs.select("doc_id", "held_out", "text").mapInPandas(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")
    return found.withColumn("doc_id", public_id("doc_id"))


def query(spark, sf_dir) -> DataFrame:
    from sluice.llm.common import table
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    return identify(table(spark, sf_dir, "documents"), held_out)
