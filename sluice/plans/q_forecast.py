"""Demand-forecast queries (W-07, S-08, ML-A..ML-D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.numeric import round_ratio_sql
from sluice.operators import forecast as FC
from sluice.operators import promotion as P
from sluice.operators.seed import draw_sql
from sluice.plans.registry import register
from sluice.sources.tables import Tables

_DAILY = f"""d AS (
  SELECT CAST(l_suppkey % {FC.N_STORES} AS INT) AS store_id, CAST(p_size % {FC.N_CATEGORIES} AS INT) AS product_category,
         CAST(l_shipdate AS DATE) AS day,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sales,
         CAST(min(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / CAST({FC.PRICE_SCALE} AS DOUBLE) AS price,
         CAST(max(l_discount) >= {FC.PROMO_DISCOUNT} AS INT) AS promotion_flag
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY l_suppkey % {FC.N_STORES}, p_size % {FC.N_CATEGORIES}, CAST(l_shipdate AS DATE)),
feat AS (
  SELECT d.store_id, d.product_category, CAST(date_diff('day', DATE '{FC.EPOCH}', d.day) AS INT) AS day_number,
         d.day, d.sales, d.price, d.promotion_flag,
         coalesce(a.sales, 0.0) AS lag_7d_sales, coalesce(b.sales, 0.0) AS lag_14d_sales,
         CAST(isodow(d.day) - 1 AS INT) AS day_of_week, CAST(weekofyear(d.day) AS INT) AS week_of_year
  FROM d LEFT JOIN d a ON a.store_id = d.store_id AND a.product_category = d.product_category AND a.day = d.day - 7
         LEFT JOIN d b ON b.store_id = d.store_id AND b.product_category = d.product_category AND b.day = d.day - 14)"""

_COLS = ["store_id", "product_category", "day_number", "day", "sales", "price", "promotion_flag", "lag_7d_sales",
         "lag_14d_sales", "day_of_week", "week_of_year"]


def _features(t: Tables):
    return FC.demand_features(t.lineitem, t.part)


@register("demand_features", "WITH " + _DAILY + "\nSELECT " + ", ".join(_COLS) + " FROM feat", ids=("W-07", "S-08"))
def q_demand_features(spark, sf_dir):
    return _features(Tables(spark, sf_dir)).select(*_COLS)


def _dbl(x) -> str:
    return f"CAST({x!r} AS DOUBLE)"


_BASE_SQL = (f"greatest({_dbl(FC.BASE_LEVEL)} + {_dbl(FC.EARLY_WEEK_LIFT)} * CAST(day_of_week < 2 AS DOUBLE)"
             f" + {_dbl(FC.SEASON_AMPLITUDE)} * sin(CAST('{2 * 3.141592653589793!r}' AS DOUBLE) * week_of_year"
             f" / {_dbl(52.0)}) + store_id * {_dbl(FC.STORE_EFFECT)} + {_dbl(FC.PRICE_ELASTICITY)} * price"
             f" + {_dbl(FC.PROMO_LIFT)} * promotion_flag + {_dbl(FC.CATEGORY_EFFECT)} * product_category,"
             f" {_dbl(0.0)})")


@register("base_demand", "WITH " + _DAILY + f"""
SELECT store_id, product_category, day_number,
       CAST(floor({_BASE_SQL} * 1000000.0 + 0.5) AS BIGINT) AS base_demand_e6 FROM feat""", ids=("S-08",))
def q_base_demand(spark, sf_dir):
    f = _features(Tables(spark, sf_dir))
    return f.select("store_id", "product_category", "day_number",
                    F.floor(FC.base_demand(f) * F.lit(1000000.0) + F.lit(0.5)).cast("bigint").alias("base_demand_e6"))


@register("holdout_split", "WITH " + _DAILY + f"""
SELECT store_id, product_category, day_number,
       CASE WHEN {draw_sql('k', 42)} < 0.2 THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, CAST(store_id AS BIGINT) * 1000003 + product_category * 100003 + day_number AS k FROM feat)""",
          ids=("ML-A",))
def q_holdout_split(spark, sf_dir):
    return FC.holdout_split(_features(Tables(spark, sf_dir))).select("store_id", "product_category", "day_number",
                                                                     "split")


# The split and the mean predictor are exact; of the trained forest the oracle states what must hold.
_TRAINED = f"""sp AS (
  SELECT CAST(sales AS HUGEINT) AS y, {draw_sql('k', 42)} < 0.2 AS test
  FROM (SELECT *, CAST(store_id AS BIGINT) * 1000003 + product_category * 100003 + day_number AS k FROM feat)),
f AS (SELECT count(*) FILTER (NOT test) AS n, sum(y) FILTER (NOT test) AS s FROM sp),
e AS (SELECT count(*) AS n_test, sum(abs(y * n - s)) AS e, any_value(n) AS n_train FROM sp, f WHERE test)"""


@register("forecaster_mae", "WITH " + _DAILY + "," + _TRAINED + f"""
SELECT 'demand_forecaster' AS model_name, n_train, n_test, {round_ratio_sql('e', 'n_train * n_test', 4)} AS mean_mae, true AS beats_mean FROM e""",
          ids=("ML-B", "ML-C", "A-12", "P-07"))
def q_forecaster_mae(spark, sf_dir):
    out = FC.train_and_evaluate(_features(Tables(spark, sf_dir)), FC.ForecastConfig())
    return out.select("model_name", "n_train", "n_test", "mean_mae", "beats_mean")


def _bins_sql(cfg) -> str:
    return ", ".join(f"CAST(floor({f} / {_dbl(cfg.widths[f])}) AS INT)" if f in cfg.widths else f"CAST({f} AS INT)" for f in cfg.features)


def forest_sql(cfg, p: str) -> str:
    """CTEs of the histogram forest, level by level from its definition; ``{p}pred`` holds the holdout's predictions."""
    n = cfg.n_trees
    draws = " UNION ALL ".join(f"SELECT {t} AS t, k, test, y, x, NOT test AND {draw_sql('k', cfg.salt(t)) + ' < 0.632' if n > 1 else 'true'} AS bag, 1 AS node FROM {p}x"
                               for t in range(n))
    out = [f"""{p}x AS (
  SELECT k, {draw_sql('k', cfg.seed)} < 0.2 AS test, CAST(sales AS BIGINT) AS y, [{_bins_sql(cfg)}] AS x
  FROM (SELECT *, CAST(store_id AS BIGINT) * 1000003 + product_category * 100003 + day_number AS k FROM feat)),
{p}r0 AS ({draws})"""]
    for d in range(cfg.max_depth):
        out.append(f"""{p}h{d} AS (
  SELECT t, node, f, x[f] AS bin, count(*) AS n, sum(y) AS s FROM {p}r{d}, (SELECT unnest(range(1, {len(cfg.features) + 1})) AS f)
  WHERE bag AND node >= {2 ** d} GROUP BY ALL),
{p}c{d} AS (
  SELECT t, node, f, bin, sum(n) OVER w AS nl, CAST(sum(s) OVER w AS DOUBLE) AS sl, sum(n) OVER g AS n, CAST(sum(s) OVER g AS DOUBLE) AS s
  FROM {p}h{d} WINDOW w AS (PARTITION BY t, node, f ORDER BY bin ROWS UNBOUNDED PRECEDING), g AS (PARTITION BY t, node, f)),
{p}s{d} AS (
  SELECT t, node, f, bin FROM (
    SELECT *, row_number() OVER (PARTITION BY t, node ORDER BY score DESC, f, bin) AS r FROM (
      SELECT *, sl * sl / CAST(nl AS DOUBLE) + (s - sl) * (s - sl) / CAST(n - nl AS DOUBLE) AS score
      FROM {p}c{d} WHERE nl >= {cfg.min_leaf} AND n - nl >= {cfg.min_leaf})
    WHERE score > s * s / CAST(n AS DOUBLE)) WHERE r = 1),
{p}r{d + 1} AS (
  SELECT r.t, k, test, y, x, bag, CASE WHEN s.f IS NULL THEN r.node ELSE 2 * r.node + CAST(x[s.f] > s.bin AS INT) END AS node
  FROM {p}r{d} r LEFT JOIN {p}s{d} s ON r.t = s.t AND r.node = s.node)""")
    last = f"{p}r{cfg.max_depth}"
    out.append(f"""{p}v AS (
  SELECT t, node, (2 * CAST(sum(y) AS HUGEINT) * 1000000 + count(*)) // (2 * count(*)) AS v FROM {last} WHERE bag GROUP BY t, node),
{p}pred AS (
  SELECT k, any_value(y) AS y, CAST((2 * sum(v) + {n}) // {2 * n} AS BIGINT) AS prediction_e6
  FROM {last} r JOIN {p}v v ON r.t = v.t AND r.node = v.node WHERE test GROUP BY k),
{p}mae AS (SELECT count(*) AS n_test, {round_ratio_sql('sum(abs(CAST(y AS HUGEINT) * 1000000 - prediction_e6))', 'count(*) * 1000000', 4)} AS mae FROM {p}pred)""")
    return ",\n".join(out)


_CHAMPION, _CHALLENGER = forest_sql(FC.EXACT_CONFIG, "a_"), forest_sql(FC.EXACT_DEGRADED_CONFIG, "b_")


@register("forecast_predictions", "WITH " + _DAILY + ",\n" + _CHAMPION + """
SELECT k, y, prediction_e6 FROM a_pred""", ids=("ML-B", "ML-C"))
def q_forecast_predictions(spark, sf_dir):
    return FC.exact_predictions(_features(Tables(spark, sf_dir)), FC.EXACT_CONFIG)


@register("forecast_mae", "WITH " + _DAILY + ",\n" + _TRAINED + ",\n" + _CHAMPION + f"""
SELECT CAST(5 AS INT) AS n_estimators, CAST(8 AS INT) AS n_features, n_train, a_mae.n_test, mae, mean_mae, mae < mean_mae AS beats_mean,
       mae <= {FC.EXACT_CONFIG.max_acceptable_mae!r} AS mae_within_threshold
FROM a_mae, (SELECT n_train, {round_ratio_sql('e', 'n_train * n_test', 4)} AS mean_mae FROM e)""", ids=("ML-C", "A-12", "P-07"))
def q_forecast_mae(spark, sf_dir):
    return FC.train_and_evaluate_exact(_features(Tables(spark, sf_dir)), FC.EXACT_CONFIG)


@register("forecast_gate", "WITH " + _DAILY + ",\n" + _TRAINED + ",\n" + _CHAMPION + ",\n" + _CHALLENGER + f"""
SELECT n_train, n_test, champion_mae, challenger_mae, champion_mae < mean_mae AS champion_beats_mean, challenger_mae <= champion_mae AS better,
       CASE WHEN challenger_mae <= champion_mae THEN 'APPROVE' ELSE 'BLOCK' END AS decision,
       CASE WHEN challenger_mae > champion_mae THEN 'ML-03' END AS rule_id
FROM (SELECT a_mae.n_test, a_mae.mae AS champion_mae, b_mae.mae AS challenger_mae FROM a_mae, b_mae),
     (SELECT n_train, {round_ratio_sql('e', 'n_train * n_test', 4)} AS mean_mae FROM e)""", ids=("ML-D",))
def q_forecast_gate(spark, sf_dir):
    feats = _features(Tables(spark, sf_dir))
    champ = FC.train_and_evaluate_exact(feats, FC.EXACT_CONFIG).select(F.struct("mae", "beats_mean")).scalar()
    chal = FC.train_and_evaluate_exact(feats, FC.EXACT_DEGRADED_CONFIG).withColumn("_c", champ).select(
        "n_train", "n_test", F.col("mae").alias("challenger_mae"), F.col("_c.mae").alias("champion_mae"),
        F.col("_c.beats_mean").alias("champion_beats_mean"), F.lit(False).alias("justified"))
    return P.gate_decision(chal).select("n_train", "n_test", "champion_mae", "challenger_mae", "champion_beats_mean", "better", "decision",
                                        F.col("finding.rule_id").alias("rule_id"))
