"""Running numbers and running minima per group that do not put a whole group in one task.

``Window.partitionBy(g).orderBy(t)`` sends every row of group ``g`` to one task; with a hot
group holding a third of the data that task is the whole job. Here the rows are range
partitioned by group and order, so a hot group, even one moment of it, spreads over
partitions that follow each other. Each task scans its rows in order, Arrow batch by batch,
and starts from nothing. A group goes on in the next partition only as that one's first
group, so what lies before a partition's rows follows from two rows a partition: the state
of its first and of its last group. These are summed up along the partitions and joined
back, a table with at most one row a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART, GROUP, NUMBER, LEAST = "_part", "_group", "_number", "_least"


class _Scan:
    """State of a scan over one partition: the open group, its rows so far, and its least row."""

    def __init__(self, least: str | None, keep: list[str]):
        self.least, self.keep = least, [*keep, NUMBER] if least else []
        self.group: str | None = None
        self.rows = 0
        self.best: pa.Table | None = None  # one row of the kept columns
        self.best_value = np.inf

    def step(self, batch: pa.RecordBatch) -> tuple[np.ndarray, pa.StructArray | None]:
        """Each row's number in its group, and the least of its group's earlier rows (the latest of equals)."""
        group, n = batch.column(GROUP), batch.num_rows
        change = np.ones(n, bool)
        change[0] = group[0].as_py() != self.group
        change[1:] = pc.not_equal(group.slice(1), group.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        segment, at = np.cumsum(change), np.arange(n)
        open_group = segment == 0
        number = at - np.maximum.accumulate(np.where(change, at, 0)) + 1
        number[open_group] = at[open_group] + 1 + self.rows
        best = None
        if self.least:
            best = self._least(batch, segment, open_group, number)
        if change.any():
            self.group = group[n - 1].as_py()
        self.rows = int(number[-1])
        return number, best

    def _least(self, batch: pa.RecordBatch, segment: np.ndarray, open_group: np.ndarray, number: np.ndarray) -> pa.StructArray:
        column, at = batch.column(self.least), np.arange(batch.num_rows)
        rated = column.is_valid().to_numpy(zero_copy_only=False)
        value = pc.fill_null(column, 0).to_numpy(zero_copy_only=False).astype(float)
        value = np.where(rated & ~np.isnan(value), value, np.inf)  # NaN is the largest number
        if self.best is None or not open_group.any():
            before_open = np.inf
        else:
            before_open = self.best_value
        frame = pd.Series(value).groupby(segment)
        lowest = frame.cummin().to_numpy()
        lowest[open_group] = np.minimum(lowest[open_group], before_open)
        first = np.concatenate([[True], segment[1:] != segment[:-1]])
        earlier = np.concatenate([[np.inf], lowest[:-1]])
        earlier[first] = np.inf
        if open_group.any():
            earlier[0] = before_open
        # a row that is at most as large takes over: of equals the latest is kept
        taken = pd.Series(np.where(rated & (value <= earlier), at, -1)).groupby(segment).cummax().to_numpy()
        held = np.concatenate([[-1], taken[:-1]])
        held[first] = -1
        carried = self.best is not None
        source = pa.table([*[batch.column(c) for c in self.keep[:-1]], pa.array(number)], names=self.keep)
        if carried:
            source = pa.concat_tables([self.best, source])
            held, taken = held + 1, taken + 1  # row 0 is the one brought along, for the open group only
        missing = np.where(open_group, held < 0, held < (1 if carried else 0))
        picked = source.take(pa.array(np.where(missing, 0, held), mask=missing)).combine_chunks()
        out = pa.StructArray.from_arrays([picked.column(c).combine_chunks() if picked.column(c).num_chunks != 1 else picked.column(c).chunk(0) for c in self.keep],
                                         names=self.keep, mask=pa.array(missing))
        last = int(taken[-1])
        if open_group[-1] and last <= 0 and carried:
            return out  # the open group went on, and its least row stays
        if last >= (1 if carried else 0):
            self.best, self.best_value = source.slice(last, 1).combine_chunks(), float(lowest[-1])
        else:
            self.best, self.best_value = None, np.inf
        return out


def _scan(least: str | None, keep: list[str], columns: list[str]):
    """Rows of one partition in order -> the same rows with their number and their group's least earlier row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, part = _Scan(least, keep), TaskContext.get().partitionId()
        for batch in batches:
            if batch.num_rows:
                number, best = scan.step(batch)
                arrays = [batch.column(c) for c in columns] + [pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(number)]
                yield pa.RecordBatch.from_arrays(arrays + ([best] if least else []), names=[*columns, PART, NUMBER] + ([LEAST] if least else []))
    return run


def _ends(least: str | None, keep: list[str], kinds: dict[str, pa.DataType]):
    """Rows of one partition in order -> the state at the end of its first and of its last group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, part, found = _Scan(least, keep), TaskContext.get().partitionId(), {}

        def note(where):
            found[where] = (scan.group, scan.rows, scan.best)

        for batch in batches:
            if not batch.num_rows:
                continue
            group, at = batch.column(GROUP), 0
            if not found:  # up to the end of the first group
                head = pc.sum(pc.equal(group, group[0])).as_py() if scan.group in (None, group[0].as_py()) else 0
                same = scan.group is None or scan.group == group[0].as_py()
                if same:
                    scan.step(batch.slice(0, head))
                    at = head
                if at < batch.num_rows:
                    note("first")
            if at < batch.num_rows:
                scan.step(batch.slice(at))
        if scan.group is not None:
            note("last")
        for group, rows, best in found.values():
            arrays = [pa.array([part], pa.int32()), pa.array([group], pa.string()), pa.array([rows], pa.int64())]
            names = [PART, GROUP, "rows"]
            if least:
                kept = [*keep, NUMBER]
                arrays.append(pa.StructArray.from_arrays(
                    [best.column(c).combine_chunks().cast(kinds[c]) if best is not None else pa.nulls(1, kinds[c]) for c in kept], names=kept, mask=pa.array([best is None])))
                names.append(LEAST)
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def group_key(groups: list[str]) -> Column:
    """The group columns as one string without nulls."""
    return F.to_json(F.array(*[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in groups]))


def running(df: DataFrame, groups: list[str], order: list[str], number: str = "row_number", least: str | None = None,
            keep: tuple[str, ...] = (), found: str = "least_row", partitions: int | None = None) -> DataFrame:
    """Add ``number``, 1, 2, ... per group in ``order`` (which makes rows unique), and with ``least`` the struct ``found``.

    ``found`` holds ``least``, the columns ``keep`` and the number of the earlier row of the group with the least value of the
    numeric column ``least``, the latest of equals; rows without that value are passed over, and it is null if there
    is none. There are as many partitions as ``spark.sql.shuffle.partitions`` says: their numbers tell the order.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = df.sparkSession
    keep = tuple(dict.fromkeys((least, *keep))) if least else ()
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = df.withColumn(GROUP, group_key(groups))
    ranged = staged.repartitionByRange(n, GROUP, *order).sortWithinPartitions(GROUP, *order)
    fields = staged.schema.fields
    kept = T.StructType([*[staged.schema[c] for c in keep], T.StructField(NUMBER, T.LongType())])
    extra = [T.StructField(PART, T.IntegerType()), T.StructField(NUMBER, T.LongType())] + ([T.StructField(LEAST, kept)] if least else [])
    rows = ranged.mapInArrow(_scan(least, list(keep), staged.columns), T.StructType([*fields, *extra]))
    ends_schema = T.StructType([T.StructField(PART, T.IntegerType()), T.StructField(GROUP, T.StringType()), T.StructField("rows", T.LongType())]
                               + ([T.StructField(LEAST, kept)] if least else []))
    kinds = {f.name: to_arrow_type(f.dataType) for f in kept.fields}
    ends = ranged.mapInArrow(_ends(least, list(keep), kinds), ends_schema)

    # what lies before a partition's first rows of a group: at most two rows a partition are summed up
    earlier = Window.partitionBy(GROUP).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    before = ends.withColumn("_before", F.sum("rows").over(earlier))
    if least:
        later = F.struct(F.col(f"{LEAST}.{least}").alias("v"), (-F.col(PART)).alias("p"), _moved("_before").alias("r"))
        before = before.withColumn("_prev", F.min(F.when(F.col(LEAST).isNotNull(), later)).over(earlier)["r"])
    before = before.where(F.col("_before").isNotNull()).select(PART, GROUP, "_before", *(["_prev"] if least else []))
    out = rows.join(F.broadcast(before), [PART, GROUP], "left")  # at most one row a partition
    total = F.col(NUMBER) + F.coalesce(F.col("_before"), F.lit(0))
    columns = [F.col(c) for c in df.columns if c not in (number, found)] + [total.alias(number)]
    if least:
        here, prev = _moved("_before"), F.col("_prev")
        mine = here.isNotNull() & (prev.isNull() | (here[least] <= prev[least]))
        columns.append(F.when(mine, here).otherwise(prev).alias(found))
    return out.select(*columns)


def _moved(before: str) -> Column:
    """The least row with its number within the partition made one within the group."""
    c = F.col(LEAST)
    return F.when(c.isNotNull(), c.withField(NUMBER, c[NUMBER] + F.coalesce(F.col(before), F.lit(0))))


def grouped_row_number(df: DataFrame, group_cols: list[str], order: list[str], name: str = "row_number", partitions: int | None = None) -> DataFrame:
    """``row_number()`` per group in ``order``."""
    return running(df, group_cols, order, name, partitions=partitions).withColumn(name, F.col(name).cast("int"))
