"""A training-corpus pipeline over ``documents``: five stages, each applying one operator of ``sluice.llm``.

Every stage works on all that the one before kept and returns the columns of ``documents``, the last one the
packed pieces. ``run`` writes each stage to the shared folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import decontaminate, jaccard_join, packing, quality, substring_dedup
from sluice.llm.common import Stored, doc_id, table, text_version, texts


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents as one struct, with the keys that the operators use: (did, tv, row)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(doc_id().alias("did"), text_version(text).alias("tv"), F.struct(*docs.columns).alias("row"))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the classifier rejects go."""
    labels = table(spark, sf_dir, "labels")
    ensemble = quality.fit(docs, labels.where(~quality.held_out()))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return quality.keep_good(rows, ensemble, docs.schema).select("row.*")


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each group of linked documents the one with the least id stays, once.

    A group is what links connect, so of a chain of texts that each resemble their neighbours one stays. Rows that
    share id and text may differ in other columns: the one with the least hash of its columns stays.
    """
    first = jaccard_join.join_similar(docs).where("group_id = did AND group_tv = tv").select("did", "tv")
    kept = _keyed(docs).join(first, ["did", "tv"], "left_semi")
    return kept.groupBy("did", "tv").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")


def repeat_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: words of repeated passages go; a changed text is the kept words joined by one space."""
    spans = substring_dedup.repeated_intervals(texts(docs))
    joined = _keyed(docs).join(spans, ["did", "tv"], "left")
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(substring_dedup.cut_spans("row.text", "spans"))
    new = {"text": text, "n_chars": F.when(F.col("spans").isNull(), F.col("row.n_chars")).otherwise(F.length(text))}
    return joined.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents whose tiles cover a benchmark item go; others of the same id (or without one) stay."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select(doc_id().alias("did"), "tv").distinct()
    return _keyed(docs).join(found, ["did", "tv"], "left_anti").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: sequences of at most 2048 tokens."""
    import public_tokenizers
    return packing.digest(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicate_filter),
    ("repeats", repeat_filter),
    ("benchmark", benchmark_filter),
    ("packing", pack),
]
#: Fitted rules, tiles and differencing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = Stored(stage(spark, docs, sf_dir), f"stage-{name}").df
    return STAGES[-1][1](spark, docs, sf_dir)
