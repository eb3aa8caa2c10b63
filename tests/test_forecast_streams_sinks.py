import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F
from support import SF_SMALL, rows

from sluice.operators import forecast as FC
from sluice.sources import sinks, views


def test_calendar_lags_use_calendar_days(spark):
    daily = spark.createDataFrame([(1, 0, 100, 5.0), (1, 0, 107, 7.0), (1, 0, 114, 9.0), (1, 0, 115, 1.0),
                                   (2, 0, 107, 3.0)], "store_id int, product_category int, day_number int, sales double")
    out = rows(FC.add_calendar_lags(daily), "store_id", "day_number", "lag_7d_sales", "lag_14d_sales")
    assert out == [(1, 100, 0.0, 0.0), (1, 107, 5.0, 0.0), (1, 114, 7.0, 5.0), (1, 115, 0.0, 0.0),
                   (2, 107, 0.0, 0.0)]


def test_holdout_split_is_stable(spark):
    df = spark.createDataFrame([(s, c, d) for s in range(5) for c in range(5) for d in range(40)],
                               "store_id int, product_category int, day_number int")
    a = FC.holdout_split(df)
    b = FC.holdout_split(df.repartition(13))
    assert a.subtract(b).count() == 0
    share = a.where("split = 'test'").count() / df.count()
    assert 0.12 < share < 0.28


def test_forest_on_generated_demand(spark):
    # a spark.range sample of the demand formula, as a training fixture
    r = spark.range(2000)
    df = r.select((F.col("id") % 7).cast("int").alias("day_of_week"), (F.col("id") % 52 + 1).cast("int").alias("week_of_year"),
                  (F.col("id") % 20).cast("int").alias("store_id"), (F.col("id") % 5).cast("int").alias("product_category"),
                  (F.col("id") % 49 + 1).cast("double").alias("price"), (F.col("id") % 2).cast("int").alias("promotion_flag"),
                  (F.col("id") % 9).cast("int").alias("day_number"))
    df = df.withColumn("sales", FC.base_demand(df)).withColumn("lag_7d_sales", F.col("sales")) \
        .withColumn("lag_14d_sales", F.col("sales"))
    cfg = FC.ForecastConfig(n_estimators=10, max_depth=6)
    res = FC.train_and_evaluate(df, cfg).first()
    assert res.n_test > 0 and res.mae < 3.0 and res.mae_within_threshold


def test_holdout_is_not_periodic(spark):
    """Neither runs of test days nor a bond between days a fortnight apart, which the lag features use."""
    df = FC.holdout_split(spark.range(4000).select(F.lit(1).alias("store_id"), F.lit(0).alias("product_category"), F.col("id").cast("int").alias("day_number")))
    test = [r.split == "test" for r in df.orderBy("day_number").collect()]
    pairs = [b for a, b in zip(test, test[14:]) if a]
    assert 0.15 < sum(test) / len(test) < 0.25 and 0.12 < sum(pairs) / len(pairs) < 0.28


def test_mean_predictor_is_exact(spark):
    df = spark.createDataFrame([(1.0, "train"), (2.0, "train"), (6.0, "train"), (4.0, "test"), (0.0, "test")], "sales double, split string")
    assert FC.mean_predictor(df).collect() == [(3, 2, 2.0)]


def test_forecast_error_band_on_sales(spark):
    features = FC.demand_features(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"), spark.read.parquet(f"{SF_SMALL}/part.parquet"))
    r = FC.train_and_evaluate(features, FC.ForecastConfig(n_estimators=20)).first()
    assert 5 < r.mae < 20 and r.n_train > 0 and r.mean_mae > 0







def test_write_table_counts_and_json_round_trip(spark, tmp_path):
    sinks.ensure_schema(spark, "sluice_test")
    df = spark.range(7).select(F.col("id").cast("string").alias("rule_id"), F.lit("t").alias("title"),
                               F.lit("c").alias("content"), F.lit("x").alias("citation"), F.lit("k").alias("category"),
                               F.lit("S").alias("severity_hint"))
    assert sinks.write_table(df, "sluice_test.rules") == 7
    assert sinks.seed_if_absent(spark, "sluice_test.rules", df) is False
    assert sinks.seed_if_absent(spark, "sluice_test.other", df) is True
    path = str(tmp_path / "rules_json")
    assert sinks.write_rules_jsonl(df, path) == 7
    assert rows(sinks.read_rules_jsonl(spark, path), "rule_id") == rows(df, "rule_id")


def test_replacing_a_table_is_all_or_nothing(spark, tmp_path):
    schema = sinks.ensure_schema(spark, "sluice_swap", location=str(tmp_path / "swap"))
    name, df = f"{schema}.t", spark.range(5).withColumn("v", F.col("id") * 2)
    assert sinks.replace_table_as(spark, name, df, ["id", "v"]) == 5
    assert sinks.replace_table_as(spark, name, spark.table(name).where("id > 1"), ["v"]) == 3  # reads what it replaces
    assert rows(spark.table(name)) == [(4,), (6,), (8,)]
    with pytest.raises(Exception):  # noqa: B017 - whatever ends the write
        sinks.replace_table_as(spark, name, spark.range(3).select((F.lit(1) / F.col("id")).cast("int").alias("v")), ["v"])
    assert rows(spark.table(name)) == [(4,), (6,), (8,)]
    assert [t.name for t in spark.catalog.listTables(schema) if "__old_" in t.name] == []


def test_a_batch_given_again_adds_no_row(spark, tmp_path):
    name = f"{sinks.ensure_schema(spark, 'sluice_batches', location=str(tmp_path / 'b'))}.t"
    batch = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    assert sinks.append_batch(batch(1, 2), name, "a") == 2
    assert sinks.append_batch(batch(3), name, "b") == 1
    assert sinks.append_batch(batch(1, 2), name, "a") == 2
    assert rows(spark.table(name)) == [(1, "a"), (2, "a"), (3, "b")]
    assert sinks.append_batch(batch(7), name, "a") == 1  # a corrected batch takes the place of the first one
    assert rows(spark.table(name), "id") == [(3,), (7,)]


def test_views_follow_their_tables(spark, tmp_path):
    schema = sinks.ensure_schema(spark, "sluice_views", location=str(tmp_path / "views"))
    columns = "route_id string, route_name string, gross_revenue double, returns_amount double, net_revenue double"
    gold = lambda *r: spark.createDataFrame(list(r), columns)
    sinks.write_table(gold(("R1", "a", 5.0, -1.0, 4.0)), f"{schema}.route_profitability")
    views.daily_route_summary(spark, schema)
    view = f"{schema}.vw_daily_route_summary"
    assert rows(spark.table(view)) == [("R1", "a", 5.0, -1.0, 4.0, 4.0)]
    sinks.replace_table_as(spark, f"{schema}.route_profitability", gold(("R1", "a", 5.0, -1.0, 4.0), ("R2", "b", 9.0, 0.0, 9.0)), gold().columns)
    assert [r.route_id for r in spark.sql(f"SELECT * FROM {view}").collect()] == ["R2", "R1"]


def test_read_rule_documents_skips_readme(spark, tmp_path):
    (tmp_path / "README.md").write_text("### [X-1] not a rule doc\n")
    (tmp_path / "naming.md").write_text("### [NM-01] Snake case\n- **Severity:** STYLE\nbody\n")
    docs = sinks.read_rule_documents(spark, str(tmp_path))
    assert rows(docs, "category") == [("naming",)]


def test_run_records_and_gate_audit(spark, tmp_path):
    schema = sinks.ensure_schema(spark, "sluice_audit", location=str(tmp_path / "audit"))
    runs = spark.createDataFrame([(1, "m", "dev", dt.datetime(2024, 1, 1), 3.5, 12.0, 100, 8), (None, "m", "dev", dt.datetime(2024, 1, 1), None, 12.0, 100, 8)],
                                 "run_id long, model_name string, env string, start_time timestamp_ntz, mae double, "
                                 "max_acceptable_mae double, n_estimators int, max_depth int")
    rec = sinks.runs_from_table(runs)
    assert sinks.append_runs(rec, f"{schema}.runs", "a") == 2 and sinks.append_runs(rec, f"{schema}.runs", "b") == 2
    assert sinks.append_runs(rec, f"{schema}.runs", "a") == 2
    assert spark.table(f"{schema}.runs").count() == 4
    got = spark.table(f"{schema}.runs").where("run_id = '1'").first()
    assert got.metrics["mae_within_threshold"] == 1.0 and got.params["n_estimators"] == "100"


def test_entry_and_registry_contract(spark):
    import __spark_entry__ as entry

    out = entry.entry(spark)
    assert set(out.columns) == {"route_id", "route_name", "gross_revenue", "returns_amount", "net_revenue",
                                "distinct_skus"}
    assert out.count() == 5
    qs, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(qs) and len(qs) >= 80
    con = duckdb.connect()
    for t in ("lineitem", "part", "supplier", "nation", "region", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ("daily_route_profitability", "usage_daily", "promotion_replay"):
        spark_rows = sorted(tuple(r) for r in qs[name](spark, SF_SMALL).collect())
        cur = con.execute(oracles[name])
        cols = [d[0] for d in cur.description]
        df = qs[name](spark, SF_SMALL)
        order = [cols.index(c) for c in df.columns]
        duck_rows = sorted(tuple(r[i] for i in order) for r in cur.fetchall())
        assert spark_rows == duck_rows, name
