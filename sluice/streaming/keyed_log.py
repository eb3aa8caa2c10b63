"""A table of changes by key that stays cheap to look up: sorted runs, merged level by level.

Micro-batches write what they change; readers want the latest row of each key. Each batch adds one
run, rows sorted by a range column into files whose least and largest value are kept in a
manifest. A lookup opens only files whose range holds one of the asked values. When a
level has ``fanout`` runs, they are merged into one run of the next level: every row is
rewritten once a level, and ``n`` batches leave at most ``fanout * log(n)`` runs.

Each epoch ends with its manifest, written beside the data and renamed into place. An
epoch that has one was applied, so a repeated batch changes nothing; files of an attempt
that failed are in no manifest. Data and manifests are plain Parquet and JSON in the
shared folder.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FANOUT = 4
ROWS_PER_FILE = 1_000_000


@dataclass(frozen=True)
class LogFile:
    """One file of a run: its level, the epoch that the run ends with, and the range of its rows."""

    path: str
    level: int
    epoch: int
    low: int
    high: int
    rows: int


class KeyedLog:
    """``keys`` name a row, ``by`` is the range column: a bigint without nulls that the keys decide.

    Rows carry ``op``: a ``delete`` hides the key until a later row; without ``op`` in the
    schema nothing is ever deleted.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], by: str, schema: T.StructType,
                 fanout: int = FANOUT, rows_per_file: int = ROWS_PER_FILE):
        self.spark, self.path, self.keys, self.by, self.fanout, self.rows_per_file = spark, path.rstrip("/"), keys, by, fanout, rows_per_file
        fields = [f for f in schema.fields if f.name != "epoch"]
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [T.StructField("epoch", T.LongType())])

    # --- manifests -----------------------------------------------------------------
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def epochs(self) -> list[int]:
        """Epochs that were applied."""
        folder, fs = self._fs(f"{self.path}/manifest")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def files(self, before: int | None = None) -> list[LogFile]:
        """The files of the latest manifest (of an epoch before ``before``)."""
        epochs = [e for e in self.epochs() if before is None or e < before]
        if not epochs:
            return []
        rows = self.spark.read.text(f"{self.path}/manifest/{epochs[-1]:012d}.json", wholetext=True).first()[0]
        return [LogFile(**f) for f in json.loads(rows)]

    def _commit(self, epoch: int, files: list[LogFile]) -> None:
        target, fs = self._fs(f"{self.path}/manifest/{epoch:012d}.json")
        staged, _ = self._fs(f"{self.path}/manifest/_{epoch:012d}-{uuid.uuid4().hex}")
        out = fs.create(staged)
        out.write(bytearray(json.dumps([asdict(f) for f in files]).encode()))
        out.close()
        fs.rename(staged, target)

    # --- writing -------------------------------------------------------------------
    def _write(self, rows: DataFrame, level: int, epoch: int) -> list[LogFile]:
        folder = f"{self.path}/data/{epoch:012d}-{level}-{uuid.uuid4().hex[:12]}"
        ordered = rows.select(*self.schema.fieldNames()).repartitionByRange(self.by, *self.keys)
        ordered.sortWithinPartitions(self.by).write.option("maxRecordsPerFile", self.rows_per_file).parquet(folder)
        written = self.spark.read.schema(self.schema).parquet(folder)
        ranges = written.groupBy(F.col("_metadata.file_path").alias("path")).agg(
            F.min(self.by).alias("low"), F.max(self.by).alias("high"), F.count(F.lit(1)).alias("rows"))
        return [LogFile(r["path"], level, epoch, r["low"], r["high"], r["rows"]) for r in ranges.collect()]  # one row a file

    def append(self, changes: DataFrame, epoch: int) -> bool:
        """Add the changes of ``epoch`` as a run and merge full levels; False if it was applied before."""
        done = self.epochs()
        if epoch in done:
            return False
        files = self.files(epoch) + self._write(changes.withColumn("epoch", F.lit(epoch).cast("bigint")), 0, epoch)
        level = 0
        while True:
            runs = {f.epoch for f in files if f.level == level}
            if len(runs) < self.fanout:
                break
            merged = [f for f in files if f.level == level]
            last = not any(f.level > level for f in files)  # nothing older is left that a deletion still hides
            rows = self._latest(self._read([f.path for f in merged]))
            files = [f for f in files if f.level != level] + self._write(rows.where("op <> 'delete'") if last and self._deletes else rows, level + 1, epoch)
            level += 1
        self._commit(epoch, files)
        return True

    def vacuum(self) -> int:
        """Delete the folders of runs that the latest manifest no longer names; only while nobody reads older states."""
        folder, fs = self._fs(f"{self.path}/data")
        kept = {f.path.rsplit("/", 2)[1] for f in self.files()}
        old = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in kept]
        for path in old:
            fs.delete(path, True)
        return len(old)

    # --- reading -------------------------------------------------------------------
    @property
    def _deletes(self) -> bool:
        return "op" in self.schema.fieldNames()

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _latest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in self.schema.fieldNames() if c not in self.keys]
        kept = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "epoch").alias("_latest"))
        return kept.select(*self.keys, *[F.col(f"_latest.{c}").alias(c) for c in rest])

    def holding(self, values: DataFrame, before: int | None = None) -> list[LogFile]:
        """The files that may hold one of the values of the range column."""
        files = sorted(self.files(before), key=lambda f: (f.level, f.epoch, f.low))
        if not files:
            return []
        runs: dict[tuple[int, int], list[int]] = {}
        for i, f in enumerate(files):
            runs.setdefault((f.level, f.epoch), []).append(i)
        lows = {r: np.array([files[i].low for i in at]) for r, at in runs.items()}
        highs = {r: np.array([files[i].high for i in at]) for r, at in runs.items()}

        def hit(frames):
            seen = np.zeros(len(files), bool)
            for frame in frames:
                v = np.unique(frame["v"].to_numpy(np.int64))
                for run, at in runs.items():
                    # files of a run follow each other; neighbours may share one value
                    first, last = np.searchsorted(highs[run], v, "left"), np.searchsorted(lows[run], v, "right")
                    marks = np.zeros(len(at) + 1, np.int64)
                    some = first < last
                    np.add.at(marks, first[some], 1)
                    np.add.at(marks, last[some], -1)
                    seen[np.array(at)[np.cumsum(marks[:-1]) > 0]] = True
            yield pd.DataFrame({"file": np.flatnonzero(seen)})

        found = values.select(F.col(self.by).alias("v")).mapInPandas(hit, "file long").distinct().collect()  # at most one row a file
        return [files[r["file"]] for r in found]

    def rows(self) -> DataFrame:
        """All rows that the files hold: versions of a key that were not merged yet are all there."""
        return self._read([f.path for f in self.files()])

    def state(self, of: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """The latest row of each key that is not deleted, of all or of the values that ``of`` holds in the range column."""
        files = self.files(before) if of is None else self.holding(of, before)
        rows = self._read([f.path for f in files])
        if of is not None:
            rows = rows.join(of.select(self.by).distinct(), self.by, "left_semi")
        latest = self._latest(rows)
        return latest.where("op <> 'delete'") if self._deletes else latest

