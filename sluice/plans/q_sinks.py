"""Catalog tables, views and file round trips over whole tables (IO-02 .. IO-12, A-02, A-03).

Each query makes a schema of its own, whose managed tables lie under the session's shared
checkpoint folder, and returns what was written, read by name (the write happens when the
query is built).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sluice.operators import retail as R
from sluice.operators import rules as RL
from sluice.plans.oracle import with_ctes
from sluice.plans.q_registry import _REPLAY, _VERSIONS, _replay
from sluice.plans.q_retail import _ROUTE_REVENUE_SQL, PRICE_REGION
from sluice.plans.q_rules import _LINES as _RULE_LINES
from sluice.plans.q_rules import _parse_sql
from sluice.plans.registry import register
from sluice.session import ensure_checkpoint_dir
from sluice.sources import sinks, views
from sluice.sources.tables import Tables


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sinks/{name}-{uuid.uuid4().hex[:12]}"


def _schema(spark) -> str:
    name = f"sluice_{uuid.uuid4().hex[:12]}"
    return sinks.ensure_schema(spark, name, location=f"{ensure_checkpoint_dir(spark).rstrip('/')}/catalog/{name}")


def _write_routes(spark, sf_dir) -> tuple[str, int]:
    t, schema = Tables(spark, sf_dir), _schema(spark)
    return schema, sinks.write_table(R.build_daily_route_profitability(t.fact_sales, t.dim_store), f"{schema}.route_profitability")


@register("route_profitability_table", with_ctes(["fact_sales", "dim_store"], f"""
WITH gold AS ({_ROUTE_REVENUE_SQL})
SELECT *, (SELECT CAST(count(*) AS BIGINT) FROM gold) AS rows_written FROM gold"""), ids=("IO-03", "IO-04"))
def q_route_profitability_table(spark, sf_dir):
    schema, n = _write_routes(spark, sf_dir)
    return spark.table(f"{schema}.route_profitability").withColumn("rows_written", F.lit(n).cast("bigint"))


@register("view_daily_route_summary", with_ctes(["fact_sales", "dim_store"], f"""
WITH gold AS ({_ROUTE_REVENUE_SQL})
SELECT route_id, route_name, SUM(gross_revenue) AS total_gross_revenue, SUM(returns_amount) AS total_returns,
       SUM(net_revenue) AS total_net_revenue, AVG(net_revenue) AS avg_net_revenue_per_route
FROM gold GROUP BY route_id, route_name"""), ids=("A-02", "T-01"))
def q_view_daily_route_summary(spark, sf_dir):
    schema, _ = _write_routes(spark, sf_dir)
    views.daily_route_summary(spark, schema)
    return spark.table(f"{schema}.vw_daily_route_summary")


@register("view_pricing_dashboard", with_ctes(["gold_pricing"], f"""
SELECT route_id, route_name, CAST(SUM(adjusted_price) AS DOUBLE) AS total_adjusted,
       CAST(SUM(base_price) AS DOUBLE) AS total_base,
       CAST(SUM(adjusted_price - base_price) AS DOUBLE) AS price_delta
FROM gold_pricing WHERE region = '{PRICE_REGION}'
GROUP BY route_id, route_name ORDER BY total_adjusted DESC, route_id LIMIT 50"""), ids=("A-03", "T-01"))
def q_view_pricing_dashboard(spark, sf_dir):
    schema = _schema(spark)
    views.view_sources(spark, schema, sf_dir, "gold_pricing")
    views.gold_pricing(spark, schema)
    views.pricing_dashboard(spark, schema, PRICE_REGION)
    return spark.table(f"{schema}.vw_pricing_dashboard")


@register("named_pricing_baseline", with_ctes(["pricing_baseline"], """
SELECT item_id, CAST(base_price AS DOUBLE) AS base_price FROM pricing_baseline"""), ids=("IO-02", "IO-01"))
def q_named_pricing_baseline(spark, sf_dir):
    schema = _schema(spark)
    views.view_sources(spark, schema, sf_dir, "pricing_baseline")
    views.pricing_baseline(spark, schema)
    return R.load_pricing_baseline(spark, schema=schema).select("item_id", F.col("base_price").cast("double").alias("base_price"))


@register("seed_dim_store_if_absent", with_ctes(["dim_store"], """
SELECT *, true AS seeded, false AS seeded_again FROM dim_store"""), ids=("IO-05",))
def q_seed_dim_store_if_absent(spark, sf_dir):
    # the first call writes the table, the second finds it and leaves it alone
    name, stores = f"{_schema(spark)}.dim_store", Tables(spark, sf_dir).dim_store
    first = sinks.seed_if_absent(spark, name, stores)
    again = sinks.seed_if_absent(spark, name, stores.limit(0))
    return spark.table(name).withColumns({"seeded": F.lit(first), "seeded_again": F.lit(again)})


@register("rule_documents", with_ctes(["handbook"], """
SELECT rule_id AS category, rule_id, title, title || chr(10) || chr(10) || regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS content, severity_hint
FROM handbook WHERE titled"""), ids=("IO-10",))
def q_rule_documents(spark, sf_dir):
    # the handbook as a folder of text files, read whole and parsed
    folder = _scratch(spark, "rule_documents")
    docs = Tables(spark, sf_dir).handbook.withColumn("name", F.concat(F.lit("IT-"), F.col("doc_id").cast("string")))
    docs.select("name", "block").write.partitionBy("name").text(folder)
    read = sinks.read_rule_documents(spark, folder, files="*.txt", name="name=([^/]+)/")
    return RL.parse_rules(read).select("category", "rule_id", "title", "content", "severity_hint")


@register("rules_table_from_jsonl", with_ctes(["rule_docs"], "WITH " + _RULE_LINES + ",\n" + _parse_sql() + """
SELECT rule_id, title, content, citation, category, severity_hint FROM parsed"""), ids=("IO-08", "IO-09"))
def q_rules_table_from_jsonl(spark, sf_dir):
    rules = RL.parse_rules(Tables(spark, sf_dir).rule_docs)
    jsonl = _scratch(spark, "rules_jsonl")
    sinks.write_rules_jsonl(rules, jsonl)
    # the table exists already, with fewer columns and rows, and is replaced
    name, read = f"{_schema(spark)}.rules", sinks.read_rules_jsonl(spark, jsonl)
    sinks.replace_table_as(spark, name, read.where("severity_hint = 'STYLE'"), ["rule_id", "title"])
    sinks.replace_table_as(spark, name, read, sinks.RULES_SCHEMA.fieldNames())
    return spark.table(name)


@register("run_records", with_ctes(["runs"], """
SELECT CAST(run_id AS VARCHAR) AS run_id, model_name, env, mae, CAST(n_estimators AS VARCHAR) AS n_estimators,
       CAST(mae <= max_acceptable_mae AS DOUBLE) AS mae_within_threshold, model_name AS tag_model_name
FROM runs"""), ids=("IO-11",))
def q_run_records(spark, sf_dir):
    name, runs = f"{_schema(spark)}.runs", Tables(spark, sf_dir).runs
    half = F.coalesce(F.pmod("run_id", F.lit(2)), F.lit(0))
    for batch in (0, 1, 0):  # two batches, the first of them delivered twice
        sinks.append_runs(sinks.runs_from_table(runs.where(half == batch)), name, f"half-{batch}")
    r = spark.table(name)
    return r.select("run_id", "model_name", "env", r.metrics["mae"].alias("mae"),
                    r.params["n_estimators"].alias("n_estimators"),
                    r.metrics["mae_within_threshold"].alias("mae_within_threshold"),
                    r.tags["model_name"].alias("tag_model_name"))


@register("gate_audit", with_ctes(["runs"], "WITH " + _VERSIONS + ",\n" + _REPLAY + """
SELECT model_name, env, version, decision,
       CAST(CASE WHEN reason = 'regression' THEN 1 ELSE 0 END AS INT) AS n_findings, reason AS justification
FROM replay"""), ids=("IO-12",))
def q_gate_audit(spark, sf_dir):
    replay = _replay(spark, sf_dir)
    rows = replay.select("model_name", "env", "version", "decision",
                         F.when(F.col("reason") == "regression", 1).otherwise(0).cast("int").alias("n_findings"),
                         F.col("reason").alias("justification"), F.lit(None).cast("string").alias("raw_response"),
                         F.col("start_time").cast("timestamp").alias("decided_at"))
    name, half = f"{_schema(spark)}.gate_decisions", F.coalesce(F.pmod("version", F.lit(2)), F.lit(0))
    for batch in (0, 1, 1):
        sinks.append_gate_decisions(rows.where(half == batch), name, f"half-{batch}")
    return spark.table(name).select("model_name", "env", "version", "decision", "n_findings", "justification")
