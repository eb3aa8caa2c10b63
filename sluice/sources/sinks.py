"""Tables of the session catalog: schemas, writes with write-time row counts, staged replacement, repeatable
appends, views over tables and files; JSON-lines round trips and the run / gate-decision audit tables.

Row counts come from ``DataFrame.observe`` during the write, so a count never re-runs the
plan (the reference's ``result.count()`` after ``saveAsTable`` does).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RULES_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                             ("rule_id", "title", "content", "citation", "category", "severity_hint")])

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("model_name", T.StringType()),
    T.StructField("env", T.StringType()), T.StructField("start_time", T.TimestampType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("config", T.StringType()),
])

GATE_DECISIONS_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()), T.StructField("env", T.StringType()),
    T.StructField("version", T.IntegerType()), T.StructField("decision", T.StringType()),
    T.StructField("n_findings", T.IntegerType()), T.StructField("justification", T.StringType()),
    T.StructField("raw_response", T.StringType()), T.StructField("decided_at", T.TimestampType()),
])


#: Partition column of tables that are appended to batch by batch.
BATCH = "batch"


def table_name(catalog: str | None, schema: str, table: str) -> str:
    """Environment-qualified name; the catalog/schema come from the caller, never from code."""
    return ".".join(p for p in (catalog, schema, table) if p)


def ensure_schema(spark: SparkSession, schema: str, catalog: str | None = None, location: str | None = None) -> str:
    """IO-05: ``CREATE SCHEMA IF NOT EXISTS``, its managed tables under ``location`` if given; the qualified name."""
    name = table_name(catalog, schema, "")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}" + (f" LOCATION '{location}'" if location else ""))
    return name


def write_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> int:
    """IO-03 + IO-04: write a managed table and return the row count observed while writing."""
    obs = Observation(f"write_{name.replace('.', '_')}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return int(obs.get["rows"])


def seed_if_absent(spark: SparkSession, name: str, df: DataFrame) -> bool:
    """IO-05: write ``df`` only when the table does not exist yet; True when written."""
    if spark.catalog.tableExists(name):
        return False
    write_table(df, name)
    return True


def replace_table_as(spark: SparkSession, name: str, source: DataFrame, columns: list[str]) -> int:
    """IO-09: create or replace a table from an explicit column list (CTAS).

    The new rows are written in full beside the table and then take its name, so readers find the old
    table or the new one, a failed write leaves the old one, and ``source`` may read the table itself.
    """
    tag = uuid.uuid4().hex[:12]
    staged, old = f"{name}__new_{tag}", f"{name}__old_{tag}"
    n = write_table(source.select(*columns), staged, mode="errorifexists")
    replaces = spark.catalog.tableExists(name)
    if replaces:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    if replaces:
        spark.sql(f"DROP TABLE {old}")
    return n


def append_batch(df: DataFrame, name: str, batch: str) -> int:
    """Append the rows of one named batch; given again, the batch replaces itself, so a retry adds no row."""
    spark = df.sparkSession
    tagged = df.withColumn(BATCH, F.lit(batch))
    if not spark.catalog.tableExists(name):
        tagged.limit(0).write.partitionBy(BATCH).saveAsTable(name)
    obs = Observation(f"append_{name.replace('.', '_')}")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode, "static")
    spark.conf.set(mode, "dynamic")  # only the partitions of this batch
    try:
        tagged.observe(obs, F.count(F.lit(1)).alias("rows")).select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)
    return int(obs.get["rows"])


def create_view(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """A view of the catalog, created or replaced from SQL text, read by its name."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")
    return spark.table(name)


def view_files(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """A view over files as they are; nothing is copied."""
    return create_view(spark, name, f"SELECT * FROM {fmt}.`{path}`")


def write_rules_jsonl(rules: DataFrame, path: str) -> int:
    """IO-08: rules as JSON lines (one object per rule)."""
    obs = Observation("rules_jsonl")
    rules.select(*RULES_SCHEMA.fieldNames()).observe(obs, F.count(F.lit(1)).alias("rows")) \
        .write.mode("overwrite").json(path)
    return int(obs.get["rows"])


def read_rules_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """IO-08: read the JSON lines back with the declared schema (no inference pass)."""
    return spark.read.schema(RULES_SCHEMA).json(path)


def read_rule_documents(spark: SparkSession, folder: str, files: str = "*.md", name: str = r"([^/]+)\.md$") -> DataFrame:
    """IO-10: rule documents, one per file (``README.md`` skipped); ``name`` takes the category out of the path."""
    docs = spark.read.text(folder, wholetext=True, pathGlobFilter=files)
    path = F.col("_metadata.file_path")
    return (docs.select(F.col("value").alias("block"), path.alias("path"))
            .where(~path.endswith("/README.md"))
            .select("path", F.regexp_extract("path", name, 1).alias("category"), "block",
                    F.xxhash64("path").alias("doc_id")))


def append_runs(runs: DataFrame, name: str, batch: str) -> int:
    """IO-11: append run records (params, metrics, tags as maps, resolved config text) of one batch."""
    return append_batch(runs.select(*RUNS_SCHEMA.fieldNames()), name, batch)


def runs_from_table(runs: DataFrame) -> DataFrame:
    """Shape the flat runs table as run records with MAP columns."""
    return runs.select(
        F.col("run_id").cast("string").alias("run_id"), "model_name", "env",
        F.col("start_time").cast("timestamp").alias("start_time"),
        F.create_map(F.lit("n_estimators"), F.col("n_estimators").cast("string"),
                     F.lit("max_depth"), F.col("max_depth").cast("string"),
                     F.lit("max_acceptable_mae"), F.col("max_acceptable_mae").cast("string")).alias("params"),
        F.create_map(F.lit("mae"), F.col("mae"), F.lit("max_acceptable_mae"), F.col("max_acceptable_mae"),
                     F.lit("mae_within_threshold"), (F.col("mae") <= F.col("max_acceptable_mae")).cast("double"))
        .alias("metrics"),
        F.create_map(F.lit("model_name"), F.col("model_name")).alias("tags"),
        F.to_json(F.struct("n_estimators", "max_depth", "max_acceptable_mae")).alias("config"),
    )


def append_gate_decisions(decisions: DataFrame, name: str, batch: str) -> int:
    """IO-12: append the gate's decision audit rows of one batch."""
    return append_batch(decisions.select(*GATE_DECISIONS_SCHEMA.fieldNames()), name, batch)
