"""Retail queries (R-01..R-10, A-01..A-03, A-13, S-01, IO-02, IO-06, IO-07)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from sluice.operators import retail as R
from sluice.operators import seed
from sluice.plans.oracle import with_ctes
from sluice.plans.registry import register
from sluice.sources.tables import Tables

PRICE_REGION = "asia"
PROMO_FACTOR = Decimal("0.90")
SEASON_FACTOR = Decimal("1.10")

_ROUTE_REVENUE_SQL = """
SELECT route_id, route_name,
       CAST(SUM(CASE WHEN NOT is_return THEN amount ELSE 0 END) AS DOUBLE) AS gross_revenue,
       CAST(SUM(CASE WHEN is_return THEN amount ELSE 0 END) AS DOUBLE) AS returns_amount,
       CAST(SUM(amount) AS DOUBLE) AS net_revenue,
       CAST(COUNT(DISTINCT sku) AS BIGINT) AS distinct_skus
FROM (SELECT s.*, d.route_id, d.route_name
      FROM (SELECT store_id, upper(regexp_replace(sku, '[^A-Za-z0-9]', '', 'g')) AS sku, amount,
                   quantity < 0 AS is_return
            FROM fact_sales WHERE is_active) s
      LEFT JOIN dim_store d ON s.store_id = d.store_id) x
GROUP BY route_id, route_name"""


@register("daily_route_profitability", with_ctes(["fact_sales", "dim_store"], _ROUTE_REVENUE_SQL),
          ids=("R-06", "R-04", "R-05"))
def q_daily_route_profitability(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return R.build_daily_route_profitability(t.fact_sales, t.dim_store)


@register("route_revenue", with_ctes(["fact_sales", "dim_store"], _ROUTE_REVENUE_SQL), ids=("R-05",))
def q_route_revenue(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return R.build_route_revenue_plain(t.fact_sales, t.dim_store)


@register("normalize_sku", with_ctes(["fact_sales"], """
SELECT order_id, line_no, upper(regexp_replace(sku, '[^A-Za-z0-9]', '', 'g')) AS sku FROM fact_sales"""),
          ids=("R-01",))
def q_normalize_sku(spark, sf_dir):
    return Tables(spark, sf_dir).fact_sales.transform(R.normalize_sku).select("order_id", "line_no", "sku")


@register("filter_active", with_ctes(["fact_sales"], """
SELECT order_id, line_no, store_id, is_active FROM fact_sales WHERE is_active"""), ids=("R-02",))
def q_filter_active(spark, sf_dir):
    return (Tables(spark, sf_dir).fact_sales.transform(R.filter_active_products)
            .select("order_id", "line_no", "store_id", "is_active"))


@register("mark_returns", with_ctes(["fact_sales"], """
SELECT order_id, line_no, quantity, quantity < 0 AS is_return, abs(quantity) AS abs_quantity FROM fact_sales"""),
          ids=("R-03",))
def q_mark_returns(spark, sf_dir):
    return (Tables(spark, sf_dir).fact_sales.transform(R.mark_returns)
            .select("order_id", "line_no", "quantity", "is_return", "abs_quantity"))


@register("enrich_with_route", with_ctes(["fact_sales", "dim_store"], """
SELECT f.order_id, f.line_no, f.store_id, d.route_id, d.route_name
FROM fact_sales f LEFT JOIN dim_store d ON f.store_id = d.store_id"""), ids=("R-04",))
def q_enrich_with_route(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return (t.fact_sales.select("order_id", "line_no", "store_id")
            .transform(R.enrich_with_route(t.dim_store.select("store_id", "route_id", "route_name"))))


@register("scan_pricing_baseline", with_ctes(["pricing_baseline"], """
SELECT item_id, CAST(base_price AS DOUBLE) AS base_price FROM pricing_baseline"""), ids=("IO-02", "IO-01"))
def q_scan_pricing_baseline(spark, sf_dir):
    return R.load_pricing_baseline(Tables(spark, sf_dir)).select(
        "item_id", F.col("base_price").cast("double").alias("base_price"))


@register("apply_promo", with_ctes(["pricing_baseline"], """
SELECT item_id, CAST(base_price AS DOUBLE) AS base_price,
       CAST(base_price * CAST(0.90 AS DECIMAL(3,2)) AS DOUBLE) AS promo_price
FROM pricing_baseline"""), ids=("R-07",))
def q_apply_promo(spark, sf_dir):
    df = R.apply_promo(Tables(spark, sf_dir).pricing_baseline, PROMO_FACTOR)
    return df.select("item_id", F.col("base_price").cast("double").alias("base_price"),
                     F.col("promo_price").cast("double").alias("promo_price"))


@register("seasonal_price", with_ctes(["seasonal_baseline"], """
SELECT season, item_id, CAST(base_price * CAST(1.10 AS DECIMAL(3,2)) AS DOUBLE) AS seasonal_price
FROM seasonal_baseline"""), ids=("R-08",))
def q_seasonal_price(spark, sf_dir):
    df = Tables(spark, sf_dir).seasonal_baseline.transform(R.add_seasonal_price(SEASON_FACTOR))
    return df.select("season", "item_id", F.col("seasonal_price").cast("double").alias("seasonal_price"))


@register("price_adjustments", with_ctes(["fact_sales", "gold_pricing"], f"""
SELECT order_id, line_no, store_id,
       (SELECT CAST(arg_min(base_price, item_id) AS DOUBLE) * CAST(1.05 AS DOUBLE)
        FROM gold_pricing WHERE region = '{PRICE_REGION}') AS adjusted_price
FROM fact_sales"""), ids=("R-09", "P-01"))
def q_price_adjustments(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return (t.fact_sales.select("order_id", "line_no", "store_id")
            .transform(R.apply_price_adjustments(PRICE_REGION, t.gold_pricing)))


_ANCHOR_SQL = """
WITH anchor AS (SELECT base_price FROM seasonal_baseline ORDER BY season, item_id LIMIT 1)
SELECT f.order_id, f.line_no, f.store_id, CAST(a.base_price AS DOUBLE) AS base_price,
       CAST(a.base_price * CAST(1.10 AS DECIMAL(3,2)) AS DOUBLE) AS seasonal_price
FROM fact_sales f, anchor a"""


@register("seasonal_prices", with_ctes(["fact_sales", "seasonal_baseline"], _ANCHOR_SQL),
          ids=("A-01", "R-10", "W-01"))
def q_seasonal_prices(spark, sf_dir):
    df = R.build_seasonal_prices(Tables(spark, sf_dir), SEASON_FACTOR)
    return df.select("order_id", "line_no", "store_id", F.col("base_price").cast("double").alias("base_price"),
                     F.col("seasonal_price").cast("double").alias("seasonal_price"))


@register("anchor_price", with_ctes(["fact_sales", "seasonal_baseline"], """
WITH anchor AS (SELECT base_price FROM seasonal_baseline ORDER BY season, item_id LIMIT 1)
SELECT f.order_id, f.line_no, CAST(a.base_price AS DOUBLE) AS base_price FROM fact_sales f, anchor a"""),
          ids=("R-10",))
def q_anchor_price(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return (t.fact_sales.select("order_id", "line_no").transform(R.attach_anchor_price(t.seasonal_baseline))
            .withColumn("base_price", F.col("base_price").cast("double")))


@register("daily_route_summary", with_ctes(["fact_sales", "dim_store"], f"""
WITH gold AS ({_ROUTE_REVENUE_SQL})
SELECT route_id, route_name, SUM(gross_revenue) AS total_gross_revenue, SUM(returns_amount) AS total_returns,
       SUM(net_revenue) AS total_net_revenue, AVG(net_revenue) AS avg_net_revenue_per_route
FROM gold GROUP BY route_id, route_name ORDER BY total_net_revenue DESC"""), ids=("A-02", "T-01"))
def q_daily_route_summary(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return R.daily_route_summary(R.build_daily_route_profitability(t.fact_sales, t.dim_store))


@register("pricing_dashboard", with_ctes(["gold_pricing"], f"""
SELECT route_id, route_name, CAST(SUM(adjusted_price) AS DOUBLE) AS total_adjusted,
       CAST(SUM(base_price) AS DOUBLE) AS total_base,
       CAST(SUM(adjusted_price - base_price) AS DOUBLE) AS price_delta
FROM gold_pricing WHERE region = '{PRICE_REGION}'
GROUP BY route_id, route_name ORDER BY total_adjusted DESC, route_id LIMIT 50"""), ids=("A-03", "T-01", "P-01"))
def q_pricing_dashboard(spark, sf_dir):
    return R.pricing_dashboard(Tables(spark, sf_dir).gold_pricing, PRICE_REGION)


@register("sku_idempotence", with_ctes(["fact_sales"], """
WITH once AS (SELECT upper(regexp_replace(sku, '[^A-Za-z0-9]', '', 'g')) AS sku FROM fact_sales)
SELECT sku FROM once EXCEPT SELECT upper(regexp_replace(sku, '[^A-Za-z0-9]', '', 'g')) AS sku FROM once"""),
          ids=("S-01",))
def q_sku_idempotence(spark, sf_dir):
    return R.sku_idempotence(Tables(spark, sf_dir).fact_sales)


@register("pipeline_checks", with_ctes(["fact_sales", "dim_store"], f"""
WITH gold AS ({_ROUTE_REVENUE_SQL}),
inv AS (SELECT count(*) FILTER (WHERE net_revenue IS NULL
                  OR abs(net_revenue - (gross_revenue + returns_amount)) >= 1e-6) AS bad,
               count(*) FILTER (WHERE distinct_skus < 1) AS few, count(*) AS n FROM gold)
SELECT 'fact_sales_populated' AS check_name, count(*) > 0 AS passed, CAST(count(*) AS BIGINT) AS observed
FROM fact_sales
UNION ALL SELECT 'dim_store_populated', count(*) > 0, CAST(count(*) AS BIGINT) FROM dim_store
UNION ALL SELECT 'net_equals_gross_plus_returns', bad = 0 AND n > 0, CAST(bad AS BIGINT) FROM inv
UNION ALL SELECT 'distinct_skus_at_least_one', few = 0 AND n > 0, CAST(few AS BIGINT) FROM inv"""),
          ids=("A-13",))
def q_pipeline_checks(spark, sf_dir):
    t = Tables(spark, sf_dir)
    gold = R.build_daily_route_profitability(t.fact_sales, t.dim_store)
    return R.pipeline_checks(t.fact_sales, t.dim_store, gold)


@register("seed_dim_store", """
SELECT printf('S%03d', CAST(s_suppkey + 1 AS INT)) AS store_id,
       'R0' || CAST(s_suppkey % 5 + 1 AS VARCHAR) AS route_id,
       ['Region North', 'Region South', 'Region East', 'Region West', 'Region Central'][CAST(s_suppkey % 5 + 1 AS INT)]
         AS route_name,
       printf('Store %03d', CAST(s_suppkey + 1 AS INT)) AS store_name
FROM supplier""", ids=("IO-06",))
def q_seed_dim_store(spark, sf_dir):
    sup = Tables(spark, sf_dir).supplier
    return seed.seed_dim_store(sup.select(F.col("s_suppkey").alias("id")))


@register("seed_fact_sales", seed.FACT_SALES_ORACLE, ids=("IO-07",))
def q_seed_fact_sales(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ids = t.lineitem.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"))
    n_stores = t.supplier.agg(F.count(F.lit(1)).cast("bigint")).scalar()
    return seed.seed_fact_sales(ids, n_stores, seed.DEFAULT_AS_OF)


@register("store_labels", """
SELECT s_suppkey, printf('S%03d', s_suppkey) AS store_id, printf('Store %03d (%s)', s_suppkey, s_name) AS label FROM supplier""", ids=("S-04",))
def q_store_labels(spark, sf_dir):
    sup = Tables(spark, sf_dir).supplier
    return sup.select("s_suppkey", F.format_string("S%03d", "s_suppkey").alias("store_id"), F.format_string("Store %03d (%s)", "s_suppkey", "s_name").alias("label"))


@register("line_math", """
SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice) AS BIGINT) AS whole, abs(25 - l_quantity) AS off,
       CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)), 2) AS DOUBLE) AS rebate,
       CAST((l_orderkey * 8 + l_linenumber) % 97 AS INT) AS bucket
FROM lineitem""", ids=("S-05",))
def q_line_math(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    price, discount = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_discount").cast("decimal(18,2)")
    return li.select("l_orderkey", "l_linenumber", F.floor("l_extendedprice").cast("bigint").alias("whole"), F.abs(F.lit(25) - F.col("l_quantity")).alias("off"),
                     F.round(price * discount, 2).cast("double").alias("rebate"), ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) % 97).cast("int").alias("bucket"))


@register("order_dates", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ordered, CAST(CAST(o_orderdate AS DATE) - INTERVAL 30 DAY AS DATE) AS month_before,
       CAST(o_orderdate AS DATE) >= DATE '1997-01-01' - INTERVAL 365 DAY AS recent
FROM orders""", ids=("S-06", "P-02"))
def q_order_dates(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return Tables(spark, sf_dir).orders.select("o_orderkey", day.alias("ordered"), F.date_sub(day, 30).alias("month_before"),
                                               (day >= F.date_sub(F.lit("1997-01-01").cast("date"), 365)).alias("recent"))


@register("part_attributes", """
SELECT p_partkey, CAST(p_size % 3 + 1 AS INT) AS picked, CASE p_size % 3 WHEN 0 THEN 'brand' WHEN 1 THEN 'type' ELSE 'name' END AS attribute,
       CASE p_size % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_type ELSE p_name END AS value, p_name AS last_value
FROM part""", ids=("S-07",))
def q_part_attributes(spark, sf_dir):
    # an array of structs per part, one element by position, its fields by name
    attributes = F.array(*[F.struct(F.lit(n).alias("attribute"), F.col(f"p_{n}").alias("value")) for n in ("brand", "type", "name")])
    parts = Tables(spark, sf_dir).part.select("p_partkey", (F.col("p_size") % 3 + 1).cast("int").alias("picked"), attributes.alias("attributes"))
    one = F.element_at("attributes", F.col("picked"))
    return parts.select("p_partkey", "picked", one["attribute"].alias("attribute"), one["value"].alias("value"),
                        F.element_at("attributes", -1)["value"].alias("last_value"))
