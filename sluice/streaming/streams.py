"""Structured Streaming versions of the gateway reports, the payload log and the rules-index sync.

Sources are file streams over the table folders (new files are new micro-batches);
event time is cast from TIMESTAMP_NTZ to TIMESTAMP before ``withWatermark``. Streams run
with ``trigger(availableNow=True)`` under the session's shared checkpoint folder, and a
run on the same root goes on where the last one ended.

Windowed reports run in update mode: every micro-batch hands over the windows that it
changed, the open ones too, and a keyed log keeps the latest version of each. So a run
ends with the whole report so far, and a later run amends it; nothing has to be flushed.
The aggregation stays Spark's own, combined on the map side, so a hot endpoint or a hot
minute never meets in one task as rows. Windows leave the state once the watermark has
passed them; rows older than that are late and not counted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import rules as RL
from sluice.operators import usage as U
from sluice.operators.usage import ENDPOINT_CALLS_PER_MINUTE, USER_CALLS_PER_MINUTE, pii_screen
from sluice.session import ensure_checkpoint_dir, is_folder
from sluice.streaming.keyed_log import KeyedLog

USAGE_WATERMARK = "1 hour"
RATE_WATERMARK = "1 minute"


# columns of the keyed logs: the range column, and the content of rows without an id
AT, ROW = "_at", "_row"


def stream_table(spark: SparkSession, sf_dir: str, table: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over ``<sf_dir>/<table>.parquet``, a folder of files or one file (schema taken from the table)."""
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)


def stream_root(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:12]}"


def run_available(df: DataFrame, name: str, output_mode: str = "append", root: str | None = None) -> DataFrame:
    """Drain a streaming DataFrame (availableNow) into parquet and return the written rows, none if nothing was.

    Passing the same ``root`` again resumes from its checkpoint (offsets, state, watermark).
    """
    spark = df.sparkSession
    root = root or stream_root(spark, name)
    q = (df.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", f"{root}/_checkpoint").option("path", f"{root}/out")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/out")


def run_batches(df: DataFrame, body, root: str, output_mode: str = "append") -> None:
    """Drain a streaming DataFrame through a ``foreachBatch`` body."""
    q = (df.writeStream.outputMode(output_mode).foreachBatch(body)
         .option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()


def drain(payload: DataFrame, report, keys: list[str], name: str, root: str | None = None) -> DataFrame:
    """Run ``report`` (stream of payload rows -> stream of windows) over all that arrived; the report so far.

    ``keys`` name a window's row; the first of them is its date or time. On the same ``root``
    a run adds what has arrived since and amends the windows that it changes.
    """
    spark = payload.sparkSession
    root = root or stream_root(spark, name)
    df = report(payload)
    at = F.unix_micros(F.col(keys[0]).cast("timestamp")).alias(AT)
    schema = df.select("*", at).schema

    def keep(batch: DataFrame, epoch: int) -> None:
        KeyedLog(batch.sparkSession, f"{root}/report", keys, AT, schema).append(batch.select("*", at), epoch)

    run_batches(df, keep, root, "update")
    return KeyedLog(spark, f"{root}/report", keys, AT, schema).state().select(*df.columns)


# --- IO-13 ----------------------------------------------------------------------------
def append_payload(payload: DataFrame, name: str = "payload", root: str | None = None, key: str = "request_id") -> DataFrame:
    """IO-13: payload rows appended to the log table as they arrive, each request once.

    A request that the log holds already is not added again, however late it is delivered
    once more; a batch reads only the files that may hold its requests. Rows that differ
    under one id count as one request (the least row); rows without id are the same request
    if all their columns are equal.
    """
    spark = payload.sparkSession
    root = root or stream_root(spark, name)
    columns = payload.columns
    content = F.when(F.col(key).isNull(), F.xxhash64(*columns)).otherwise(F.lit(0).cast("bigint")).alias(ROW)
    at = F.coalesce(F.col(key).cast("bigint"), F.col(ROW)).alias(AT)
    schema = payload.select("*", content).select("*", at).schema
    same = [key, ROW]

    def keep(batch: DataFrame, epoch: int) -> None:
        log = KeyedLog(batch.sparkSession, f"{root}/log", same, AT, schema)
        rest = [c for c in columns if c != key]
        once = (batch.select("*", content).groupBy(*same).agg(F.min(F.struct(*rest)).alias("_r"))
                .select(key, *[F.col(f"_r.{c}").alias(c) for c in rest], ROW).select("*", at))
        known = log.state(of=once, before=epoch).select(F.col(key).alias("_k"), F.col(ROW).alias("_h"))
        log.append(once.join(known, F.col(key).eqNullSafe(F.col("_k")) & (F.col(ROW) == F.col("_h")), "left_anti"), epoch)

    run_batches(payload, keep, root)
    return KeyedLog(spark, f"{root}/log", same, AT, schema).state().select(*columns)


def _event_time(col: str) -> Column:
    return F.col(col).cast("timestamp")


# --- ST-01 ----------------------------------------------------------------------------
def _usage(windowed: DataFrame) -> DataFrame:
    """The batch report's measures per window of one day."""
    agg = windowed.groupBy(F.window("event_ts", "1 day").alias("w")).agg(*U.usage_measures())
    return agg.select(*U.usage_columns(F.col("w.start").cast("date")))


def usage_daily_stream(payload: DataFrame, watermark: str = USAGE_WATERMARK) -> DataFrame:
    """ST-01: daily usage over a payload stream (1-day tumbling windows, append mode)."""
    return _usage(payload.withColumn("event_ts", _event_time("request_time")).withWatermark("event_ts", watermark))


def usage_daily_closed(payload: DataFrame, watermark: str = USAGE_WATERMARK) -> DataFrame:
    """The days that an unflushed ST-01 has emitted: their window closed under the final watermark."""
    ts = _event_time("request_time")
    limit = payload.agg(F.max(ts).alias("m")).select(F.col("m") - F.expr(f"INTERVAL {watermark}")).scalar()
    days = payload.withColumn("event_ts", ts).withColumn("_end", F.window("event_ts", "1 day")["end"])
    return _usage(days.where(F.col("_end") <= limit))


# --- ST-02 ----------------------------------------------------------------------------
def _keyed_calls(payload: DataFrame) -> DataFrame:
    return payload.select(
        _event_time("request_time").alias("event_ts"),
        F.explode(F.array(F.struct(F.lit("endpoint").alias("key_type"), F.col("endpoint").alias("key")),
                          F.struct(F.lit("user").alias("key_type"), F.col("requester").alias("key")))).alias("_k"),
    ).select("event_ts", "_k.key_type", "_k.key")


def _breaches(agg: DataFrame, endpoint_limit: int, user_limit: int) -> DataFrame:
    limit = F.when(F.col("key_type") == "endpoint", F.lit(endpoint_limit)).otherwise(F.lit(user_limit))
    return agg.where(F.col("calls") > limit).select(
        "key_type", "key", F.col("w.start").cast("timestamp_ntz").alias("minute"),
        F.col("calls").cast("bigint").alias("calls"),
        limit.cast("int").alias("limit_per_minute"))


RATE_KEYS = ["minute", "key_type", "key"]


def rate_limit_stream(payload: DataFrame, endpoint_limit: int = ENDPOINT_CALLS_PER_MINUTE,
                      user_limit: int = USER_CALLS_PER_MINUTE, watermark: str = RATE_WATERMARK) -> DataFrame:
    """ST-02: per-minute calls per endpoint and per user over a stream; late rows are dropped."""
    s = _keyed_calls(payload).withWatermark("event_ts", watermark)
    agg = s.groupBy("key_type", "key", F.window("event_ts", "1 minute").alias("w")).agg(
        F.count(F.lit(1)).alias("calls"))
    return _breaches(agg, endpoint_limit, user_limit)


def rate_limit_closed(payload: DataFrame, endpoint_limit: int = ENDPOINT_CALLS_PER_MINUTE,
                      user_limit: int = USER_CALLS_PER_MINUTE, watermark: str = RATE_WATERMARK) -> DataFrame:
    """Batch twin of ST-02 (windows closed under the final watermark)."""
    ts = _event_time("request_time")
    limit = payload.agg(F.max(ts).alias("m")).select(F.col("m") - F.expr(f"INTERVAL {watermark}")).scalar()
    agg = (_keyed_calls(payload).groupBy("key_type", "key", F.window("event_ts", "1 minute").alias("w"))
           .agg(F.count(F.lit(1)).alias("calls")).where(F.col("w.end") <= limit))
    return _breaches(agg, endpoint_limit, user_limit)


# --- ST-03 ----------------------------------------------------------------------------
RULE_COLUMNS = ("rule_id", "title", "content", "citation", "category", "severity_hint")
INDEX_KEY = ["doc_id", "rule_id"]


def index_log(spark: SparkSession, path: str, doc_type: str = "bigint") -> KeyedLog:
    """The index: changed rules by document, ``op`` insert, update or delete."""
    texts = ", ".join(f"{c} string" for c in RULE_COLUMNS)
    schema = spark.createDataFrame([], f"doc_id {doc_type}, {texts}, op string, {AT} bigint").schema
    return KeyedLog(spark, path, INDEX_KEY, AT, schema)


def index_sync_batch(log_path: str):
    """``foreachBatch`` body: the batch's rule documents against what the index holds of the same documents.

    The index is a keyed log over ``doc_id``: a batch reads the files whose range of ids holds
    one of its documents, and writes changed rows only: rules that are new, differ in
    content, or are gone from a document that arrived again. A repeated epoch writes nothing.
    """

    def _apply(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        at = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias(AT)
        log = index_log(spark, log_path, batch.schema["doc_id"].dataType.simpleString())
        docs = batch.select("doc_id", at).distinct()
        new = RL.parse_rules(batch).select("doc_id", *RULE_COLUMNS)
        old = log.state(of=docs, before=epoch_id).drop("op").join(docs, ["doc_id", AT], "left_semi")
        sides = new.select(*INDEX_KEY, F.struct(*RULE_COLUMNS).alias("n")).join(
            old.select(*INDEX_KEY, F.struct(*RULE_COLUMNS).alias("o")), INDEX_KEY, "full_outer")
        same = RL.content_hash_of("n") == RL.content_hash_of("o")
        op = F.when(F.col("o").isNull(), "insert").when(F.col("n").isNull(), "delete").when(~same, "update")
        changed = sides.withColumn("op", op).where(F.col("op").isNotNull()).withColumn("row", F.coalesce("n", "o"))
        log.append(changed.select("doc_id", "op", "row.*", at), epoch_id)

    return _apply


def index_state(spark: SparkSession, log_path: str) -> DataFrame:
    """Rules that the index holds: the latest change of each, deleted ones left out."""
    return index_log(spark, log_path).state().select("doc_id", *RULE_COLUMNS)


def run_index_sync(rule_docs_stream: DataFrame, name: str = "index_sync", root: str | None = None) -> DataFrame:
    """ST-03: drain the rule-document stream through ``foreachBatch``; return the log's rows (changes not yet merged).

    Passing the same ``root`` again resumes the stream (and its index) from the checkpoint.
    """
    spark = rule_docs_stream.sparkSession
    root = root or stream_root(spark, name)
    run_batches(rule_docs_stream, index_sync_batch(f"{root}/index"), root)
    return index_log(spark, f"{root}/index").rows()


# --- ST-04 ----------------------------------------------------------------------------
def pii_screen_stream(docs: DataFrame) -> DataFrame:
    """ST-04: the input screen as a stateless stream (same columns as the batch screen)."""
    return pii_screen(docs)
