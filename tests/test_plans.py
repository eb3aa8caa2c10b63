"""Plan-shape guards: no cross products, top-k as group limits, scans pruned and filtered."""

import re

import pytest
from support import SF_SMALL

from sluice.plans.registry import load_all

GUARDED = ["daily_route_profitability", "price_adjustments", "seasonal_prices", "promotion_replay", "config_diff",
           "policy_scan", "check_annotations", "text_top_k", "vector_top_k", "demand_features", "pricing_dashboard"]


def _plan(spark, name):
    return load_all()[name].fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", GUARDED)
def test_no_cross_products(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_caps_plan_as_group_limits(spark):
    assert "WindowGroupLimit" in _plan(spark, "text_top_k")


@pytest.mark.parametrize("name,table,scans", [("as_added_diff", "documents", 1), ("file_checks", "documents", 1), ("parse_decisions", "labels", 1),
                                              ("decision_findings", "labels", 1), ("rules_text", "documents", 1), ("seasonal_prices", "p_type", 1)])
def test_each_table_is_read_once(spark, name, table, scans):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(spark, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    found = [x for x in re.findall(r"FileScan parquet [^\n]*", plan) if table in x]
    assert len(set(found)) == scans, name  # a plan's text may show one scan twice, two scans differ in their ids


def test_scans_are_pruned_and_filtered(spark):
    plan = _plan(spark, "daily_route_profitability")
    schema = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem", plan).group(1)
    assert "l_shipdate" not in schema and "l_comment" not in schema  # only needed columns are read
    assert "EqualTo(l_linestatus,O)" in plan  # the active filter reaches the parquet scan


def test_the_replay_shuffles_the_runs_once_and_joins_no_champion(spark):
    """One range exchange of the runs, read twice without coalescing; the only join is with a row a partition, no champion is looked up."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        from sluice.operators import registry as G
        from sluice.sources.tables import Tables
        for df in (G.promotion_replay(Tables(spark, SF_SMALL).runs), G.config_diff(G.promotion_replay(Tables(spark, SF_SMALL).runs))):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert len(set(re.findall(r" Exchange rangepartitioning\(_group[^\n]*plan_id=([0-9]+)", plan))) == 1
            assert "REPARTITION_BY_NUM" in plan  # not coalesced: the numbers of partitions tell their order
            assert "ReusedExchange" in plan
            assert "champion_run_id" not in " ".join(re.findall(r"Join[^\n]*", plan))
            assert len(re.findall(r"(?:SortMerge|Hash)Join", plan)) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
