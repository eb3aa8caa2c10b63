import datetime as dt
import random

from support import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from sluice.functions.scan import grouped_row_number, running
from sluice.operators import promotion as P
from sluice.operators import registry as G

RUN_SCHEMA = ("run_id long, model_name string, env string, start_time timestamp_ntz, mae double, "
              "max_acceptable_mae double, n_estimators int, max_depth int, min_samples_leaf int, features string")


def _runs(spark, maes, model="m", env="dev"):
    t0 = dt.datetime(2024, 1, 1)
    data = [(i + 1, model, env, t0 + dt.timedelta(hours=i), m, 12.0, 100, 8, 5, "a,b") for i, m in enumerate(maes)]
    return spark.createDataFrame(data, RUN_SCHEMA)


def test_replay_matches_strict_rule(spark):
    v = G.register_versions(_runs(spark, [9.0, 10.0, 9.0, 8.0, 8.5]))
    out = [(r.version, r.decision, r.champion_version) for r in G.promotion_replay(v).orderBy("version").collect()]
    assert out == [(1, "APPROVE", None), (2, "BLOCK", 1), (3, "APPROVE", 1), (4, "APPROVE", 3), (5, "BLOCK", 4)]


def test_alias_state_and_metrics(spark):
    v = G.register_versions(_runs(spark, [9.0, 10.0, 8.0]))
    state = G.alias_state(G.alias_events(G.promotion_replay(v)))
    assert rows(state, "alias", "version") == [("challenger", 3), ("champion", 3)]
    v2 = G.register_versions(_runs(spark, [9.0], model="solo"))
    state2 = G.alias_state(G.alias_events(G.promotion_replay(v2).withColumn("decision", F.lit("BLOCK"))))
    m = G.alias_metrics(state2)
    assert rows(m, "alias", "status") == [("challenger", "found"), ("champion", "none")]


def test_compare_metrics_cases(spark):
    pairs = [(8.0, 9.0), (10.0, 9.0), (9.0, 9.0), (8.5, 9.2), (15.0, 9.0), (0.0, 0.0)]
    df = spark.createDataFrame(pairs, "mae double, champion_mae double")
    out = {(r.mae, r.champion_mae): r for r in G.compare_metrics(df).collect()}
    assert out[(8.0, 9.0)].better and out[(9.0, 9.0)].better and not out[(10.0, 9.0)].better
    assert out[(0.0, 0.0)].pct_change == 0.0
    assert out[(8.0, 9.0)].summary == "Challenger MAE: 8.0000 vs Champion MAE: 9.0000 - improved by 1.0000 (11.1%)"
    assert out[(15.0, 9.0)].summary.startswith("Challenger MAE: 15.0000 vs Champion MAE: 9.0000 - degraded by 6.0000 (66.7%)")


def test_gate_decision_bootstrap_justified_and_missing(spark):
    df = spark.createDataFrame([(3.5, None, False), (6.57, 3.52, False), (6.57, 3.52, True), (None, 3.0, False),
                                (3.0, 3.5, False)], "challenger_mae double, champion_mae double, justified boolean")
    out = [(r.challenger_mae, r.champion_mae, r.justified, r.decision) for r in P.gate_decision(df).collect()]
    assert [d for *_, d in out] == ["APPROVE", "BLOCK", "APPROVE", "BLOCK", "APPROVE"]


def test_config_diff_and_sync_check(spark):
    runs = _runs(spark, [9.0, 8.0]).withColumn(
        "n_estimators", F.when(F.col("run_id") == 2, F.lit(5)).otherwise(F.col("n_estimators")))
    v = G.register_versions(runs)
    diff = G.config_diff(G.promotion_replay(v))
    assert rows(diff, "version", "key", "old_value", "new_value", "change") == [(2, "n_estimators", "100", "5", "changed")]
    sync = G.config_sync_check(diff).collect()
    assert [(r.version, r.rule_id) for r in sync] == [(2, "ML-01")]
    assert G.config_sync_of(G.promotion_replay(v)).collect() == sync


def test_config_validity_failures(spark):
    df = spark.createDataFrame([
        (1, "m", {"n_estimators": "100", "max_depth": "8", "min_samples_leaf": "5"}, ["a"], 12.0),
        (2, "m", {"n_estimators": "0", "max_depth": "8", "min_samples_leaf": "5"}, [], 12.0),
        (3, "", {"max_depth": "8", "min_samples_leaf": "5"}, ["a"], -1.0)],
        "config_id int, model_name string, hyperparameters map<string,string>, features array<string>, "
        "max_acceptable_mae double")
    assert rows(G.config_validity(df), "config_id", "check", "field") == [
        (2, "empty", "features"), (2, "non_positive", "n_estimators"), (3, "missing", "model_name"),
        (3, "missing", "n_estimators"), (3, "non_positive", "max_acceptable_mae")]


def test_resolve_version_and_retention(spark):
    v = G.register_versions(_runs(spark, [9.0, 8.0, 10.0]))
    state = G.alias_state(G.alias_events(G.promotion_replay(v)))
    req = spark.createDataFrame([(1, "m", "dev", "2"), (2, "m", "dev", "@prod"), (3, "m", "dev", "")],
                                "request_id int, model_name string, env string, requested string")
    assert rows(G.resolve_version(req, state), "request_id", "version", "resolved_by") == [
        (1, 2, "pinned"), (2, 2, "alias"), (3, 2, "alias")]
    ret = G.registry_retention(v)
    assert rows(ret, "version", "action") == [(1, "keep_as_champion"), (2, "delete"), (3, "delete")]
    assert rows(G.registry_retention(v, ("dev",)), "action") == [("delete",)] * 3


def _least_by_window(df):
    """Number and least earlier row (the latest of equals) by one window over each whole group."""
    w = Window.partitionBy("g").orderBy("t", "id")
    numbered = df.withColumn("n", F.row_number().over(w))
    best = F.min(F.when(F.col("v").isNotNull(), F.struct("v", (-F.col("n")).alias("m"), "id", "x"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return numbered.withColumn("b", best).select("g", "id", "n", "b.v", "b.id", "b.x", (-F.col("b.m")).alias("m"))


def _least_by_scan(df, partitions):
    out = running(df, ["g"], ["t", "id"], "n", least="v", keep=("v", "id", "x"), found="b", partitions=partitions)
    return out.select("g", "id", "n", "b.v", "b.id", "b.x", "b._number")


def test_scan_equals_window_with_hot_group(spark):
    """Hot, tiny and null groups, equal order keys, missing values and ties, over more and fewer partitions than groups."""
    random.seed(7)
    data = [(random.choice(["hot"] * 6 + [None, "", "=", f"g{random.randint(0, 200)}"]), i, random.choice([3, 3, 3, random.randint(0, 50)]),
             random.choice([None, float(random.randint(0, 30))]), random.choice([None, f"x{i}"])) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, id long, t int, v double, x string")
    want = rows(_least_by_window(df))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")  # groups and champions go on from batch to batch
    try:
        for partitions in (1, 7, 64):
            assert rows(_least_by_scan(df, partitions)) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    rn = grouped_row_number(df, ["g"], ["t", "id"])
    wr = Window.partitionBy("g").orderBy("t", "id")
    assert rows(rn, "g", "id", "row_number") == rows(df.select("g", "id", F.row_number().over(wr).alias("rn")))
    assert running(df.limit(0), ["g"], ["t", "id"], "n", least="v", keep=("v",)).count() == 0


def test_one_moment_of_one_group_is_split(spark):
    """A group whose rows all have one start time: many tasks scan it, without a bounds array or a window over it."""
    df = spark.range(4000).select(F.lit("one").alias("g"), "id", F.lit(5).alias("t"), F.lit(1.0).alias("v"))
    out = running(df, ["g"], ["t", "id"], "n", least="v", keep=("id",), found="b", partitions=8)
    assert out.where("n <> id + 1 OR (id > 0 AND b.id <> id - 1)").count() == 0
    parts = out.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(parts) >= 6 and max(r["count"] for r in parts) < 1500
    plan = out._jdf.queryExecution().toString()
    assert "percentile" not in plan and "filter(" not in plan


def test_replay_over_buckets_equals_a_scan(spark):
    """Ties, missing metrics and a hot model, with more partitions than some groups have rows."""
    rng = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    data = [(i, "hot" if rng.random() < 0.7 else f"m{i % 3}", "dev", t0 + dt.timedelta(hours=rng.randrange(60)),
             None if rng.random() < 0.1 else float(rng.randrange(40)), float(rng.randrange(10, 13)), rng.choice([None, 5]), 8, 5, rng.choice([None, "a"]))
            for i in range(400)]
    out = {r.run_id: r for r in G.promotion_replay(spark.createDataFrame(data, RUN_SCHEMA), partitions=16).collect()}
    groups = {}
    for d in sorted(data, key=lambda d: (d[3], d[0])):
        seen, r = groups.setdefault(d[1], []), out[d[0]]
        rated = [(x[4], -x[3].timestamp(), -x[0], n + 1, x) for n, x in enumerate(seen) if x[4] is not None]
        champion = min(rated) if rated else None
        assert r.version == len(seen) + 1
        assert (r.champion_run_id, r.champion_version) == ((champion[4][0], champion[3]) if champion else (None, None))
        if champion:
            assert r.champion_params == {k: v for k, v in (("n_estimators", "5" if champion[4][6] else None), ("max_depth", "8"), ("min_samples_leaf", "5"),
                                                           ("features", champion[4][9]), ("max_acceptable_mae", str(champion[4][5]))) if v is not None}
        seen.append(d)


def test_config_sync_compares_columns(spark):
    """Every key missing, changed or equal on either side: as the change set says, without a map or a lambda a row."""
    rng = random.Random(9)
    t0 = dt.datetime(2024, 1, 1)
    data = [(i, f"m{i % 4}", "dev", t0 + dt.timedelta(hours=i), rng.choice([None, float(rng.randrange(9))]), rng.choice([None, 10.0, 11.0]),
             rng.choice([None, 5, 6]), rng.choice([None, 8]), 5, rng.choice([None, "a", "b"])) for i in range(300)]
    replay = G.promotion_replay(spark.createDataFrame(data, RUN_SCHEMA), partitions=4)
    sync = G.config_sync_of(replay)
    assert rows(sync) == rows(G.config_sync_check(G.config_diff(replay))) and 20 < sync.count() < 280
    plan = sync._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "map_from_arrays" not in plan


def test_config_diff_kinds(spark):
    runs = _runs(spark, [9.0, 8.0, 7.0]).withColumns({
        "n_estimators": F.when(F.col("run_id") != 2, F.col("n_estimators")), "features": F.when(F.col("run_id") == 3, "a").otherwise("a,b")})
    diff = G.config_diff(G.promotion_replay(runs))
    assert rows(diff, "version", "key", "old_value", "new_value", "change") == [
        (2, "n_estimators", "100", None, "removed"), (3, "features", "a,b", "a", "changed"), (3, "n_estimators", None, "100", "added")]
    assert sorted((r.version, r.rule_id) for r in G.config_sync_check(diff).collect()) == [(2, "ML-01"), (3, "ML-01")]
    assert sorted((r.version, r.rule_id) for r in G.config_sync_of(G.promotion_replay(runs)).collect()) == [(2, "ML-01"), (3, "ML-01")]


def test_mae_of_large_sums_does_not_overflow(spark):
    from decimal import Decimal as D
    p = spark.createDataFrame([(1, D("50000000000000.00"), D("0.00"))] * 3, "run_id int, y decimal(18,2), yhat decimal(18,2)")
    assert rows(G.mae_by_run(p), "run_id", "mae") == [(1, 5e13)]


def test_mae_by_run(spark):
    from decimal import Decimal as D
    p = spark.createDataFrame([(1, D("3.00"), D("1.00")), (1, D("1.00"), D("2.50")), (2, D("5.00"), D("5.00"))],
                              "run_id int, y decimal(18,2), yhat decimal(18,2)")
    assert rows(G.mae_by_run(p), "run_id", "mae") == [(1, 1.75), (2, 0.0)]
