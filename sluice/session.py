"""Session helpers: one place for the engine settings every job relies on.

Jobs never build their own session inside a transform (TP-01); entry points call
``get_session`` once and pass DataFrames down.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Broadcast only what the optimizer can prove small. 64 MiB per executor copy keeps
# the hash relation far below executor memory on a large cluster.
DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024

_ENGINE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "Etc/UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(DEFAULT_BROADCAST_LIMIT),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sluice") -> SparkSession:
    """Build (or reuse) a session with the engine settings above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode runs every task in the driver JVM; a cluster sizes executors itself
            builder = builder.config("spark.driver.memory", os.environ.get("SLUICE_DRIVER_MEMORY", "16g"))
    for k, v in _ENGINE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names; a temporary one only in local mode (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext, the conf is the source
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not configured:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # one machine runs everything: a temporary folder, removed when the process ends
        configured = tempfile.mkdtemp(prefix="sluice-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def written_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there: cuts the lineage, survives lost executors.

    The files are deleted when the driver ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_delete_path, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _delete_path(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may have ended before
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def session_key(spark: SparkSession) -> str:
    """A stable identifier of the session's application (for per-session caches)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect
        return spark.conf.get("spark.app.id", str(id(spark)))


def estimated_size(df: DataFrame) -> int | None:
    """Optimizer's size estimate of a plan in bytes (no job is run)."""
    try:
        return _as_int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except Exception:  # noqa: BLE001 - estimate unavailable, e.g. remote session
        return None


def _as_int(v) -> int:
    """py4j returns BigInteger-backed sizes as Python ints; other JVM numbers via text."""
    return v if isinstance(v, int) else int(v.toString())


def lookup_bound_size(df: DataFrame) -> int | None:
    """Size bound for a dimension built from one base scan joined many-to-one to lookups:
    the largest leaf of its plan (the optimizer's join estimate multiplies the sides)."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [_as_int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
        return max(sizes) if sizes else estimated_size(df)
    except Exception:  # noqa: BLE001
        return None


def fits_broadcast(df: DataFrame, limit: int = DEFAULT_BROADCAST_LIMIT, lookup: bool = False) -> bool:
    size = lookup_bound_size(df) if lookup else estimated_size(df)
    return size is not None and size <= limit


def sized_broadcast(df: DataFrame, limit: int = DEFAULT_BROADCAST_LIMIT, basis: DataFrame | None = None) -> DataFrame:
    """Broadcast-hint ``df`` only when its estimated size is within ``limit``.

    Beyond the limit the plain DataFrame is returned, so the planner falls back to a
    shuffle join (sort-merge, with AQE skew splitting) instead of shipping an unbounded
    relation to every executor. ``basis`` bounds ``df`` when ``df`` is ``basis`` joined
    many-to-one to fixed lookup tables: the optimizer multiplies join sizes, so the
    basis scan is the tighter proven bound.
    """
    size = estimated_size(basis if basis is not None else df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder of the (shared) file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the (shared) file system, without a failing read."""
    try:
        jvm = spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))
    except Exception:  # noqa: BLE001 - no JVM handle (Spark Connect): probe with a read
        try:
            spark.read.parquet(path).schema  # noqa: B018
            return True
        except Exception:  # noqa: BLE001
            return False
