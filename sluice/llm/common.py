"""Helpers shared by the training-data operators.

Conventions that every operator here follows:

* a null ``doc_id`` is the smallest id (``NULL_ID``), a null text is the empty text;
* only the named input columns are read, so extra columns (whatever their names) are ignored;
* intermediate tables go to the folder that ``spark.checkpoint.dir`` names, never to a local one.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import ensure_checkpoint_dir

NULL_ID = -(1 << 63)
U64 = np.uint64
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_id(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(col).cast("bigint"), F.lit(NULL_ID))


def public_id(col: str) -> Column:
    """The inverse of ``doc_id``: the sentinel of a null id becomes null again."""
    return F.when(F.col(col) != NULL_ID, F.col(col))


#: Bytes of rows that one batch carries to a Python worker: long texts come in few rows at a time.
BATCH_BYTES = 4 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches bounded by bytes as well as by rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def text_version(text: Column) -> Column:
    """64 bits that tell the texts of one id apart; a hot id (null) has many."""
    return F.xxhash64(text)


def texts(docs: DataFrame) -> DataFrame:
    """(did, tv, text): id without nulls, a text version telling rows of one id apart, text without nulls."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return bounded_batches(docs).select(doc_id().alias("did"), text_version(text).alias("tv"), text.alias("text"))


class Stored:
    """A table written once to the shared folder: it cuts the lineage and survives lost executors.

    Tables that a returned frame still reads are deleted when the driver ends, others by ``drop``.
    """

    left: dict[str, SparkSession] = {}

    def __init__(self, df: DataFrame, name: str):
        spark = df.sparkSession
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
        # the shuffle files of the job that fills the table are of no use once it is written
        before = spark.conf.get(CLEANUP, None)
        spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(self.path)
        finally:
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
        Stored.left[self.path] = spark
        self.df = spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete the files; only after every table that reads them has been stored itself."""
        _delete(Stored.left.pop(self.path), self.path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _delete_left() -> None:
    while Stored.left:
        name, spark = Stored.left.popitem()
        with contextlib.suppress(Exception):  # the JVM may have ended before
            _delete(spark, name)


class WordHash(dict):
    """bytes word -> 64-bit hash, remembered for frequent words; ``trim`` bounds the memory."""

    LIMIT = 250_000

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def trim(self) -> None:
        if len(self) > self.LIMIT:
            self.clear()

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=U64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash, so that its order says nothing about the words."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BASE = U64(0x9E3779B97F4A7C15)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each position on (positions with fewer words left are dropped)."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, U64)
    out = np.zeros(size, U64)
    for i in range(n):
        out = out * BASE + words[i:i + size]
    return mix(out)


def chunks(frames, weight: int, size=len):
    """Rows of a stream of pandas frames in lists whose texts are about ``weight`` bytes together."""
    held, total = [], 0
    for frame in frames:
        for row in frame.itertuples(index=False, name=None):
            held.append(row)
            total += 200 + size(row[-1])
            if total >= weight:
                yield held
                held, total = [], 0
    if held:
        yield held
