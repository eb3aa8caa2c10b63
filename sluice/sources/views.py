"""SQL text of the catalog views, by name; ``{schema}`` is where their inputs are.

The views stand on tables or on other views of the same schema. ``route_profitability`` is the table
that the route job writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.sources import sinks

SOURCES = {"pricing_baseline": ["part"], "gold_pricing": ["lineitem", "part", "supplier", "nation", "region"]}

PRICING_BASELINE = """
SELECT p_partkey AS item_id, CAST(p_retailprice AS DECIMAL(18,2)) AS base_price FROM {schema}.part"""

GOLD_PRICING = """
SELECT concat('N', lpad(n_nationkey, 2, '0')) AS route_id, n_name AS route_name, lower(r_name) AS region, p_partkey AS item_id,
       CAST(p_retailprice AS DECIMAL(18,2)) AS base_price,
       CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(1.05 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS adjusted_price
FROM {schema}.lineitem
JOIN {schema}.part ON p_partkey = l_partkey
JOIN {schema}.supplier ON s_suppkey = l_suppkey
JOIN {schema}.nation ON n_nationkey = s_nationkey
JOIN {schema}.region ON r_regionkey = n_regionkey"""

DAILY_ROUTE_SUMMARY = """
SELECT route_id, route_name, sum(gross_revenue) AS total_gross_revenue, sum(returns_amount) AS total_returns,
       sum(net_revenue) AS total_net_revenue, avg(net_revenue) AS avg_net_revenue_per_route
FROM {schema}.route_profitability
GROUP BY ALL
ORDER BY total_net_revenue DESC, route_id"""

PRICING_DASHBOARD = """
SELECT route_id, route_name, CAST(sum(adjusted_price) AS DOUBLE) AS total_adjusted, CAST(sum(base_price) AS DOUBLE) AS total_base,
       CAST(sum(adjusted_price - base_price) AS DOUBLE) AS price_delta
FROM {schema}.gold_pricing
WHERE region = '{region}'
GROUP BY ALL
ORDER BY total_adjusted DESC, route_id
LIMIT {top_n}"""


def view_sources(spark: SparkSession, schema: str, sf_dir: str, view: str) -> None:
    """The parquet tables that ``view`` stands on, as views over their files."""
    for table in SOURCES[view]:
        sinks.view_files(spark, f"{schema}.{table}", f"{sf_dir.rstrip('/')}/{table}.parquet")


def pricing_baseline(spark: SparkSession, schema: str) -> DataFrame:
    return sinks.create_view(spark, f"{schema}.pricing_baseline", PRICING_BASELINE.format(schema=schema))


def gold_pricing(spark: SparkSession, schema: str) -> DataFrame:
    return sinks.create_view(spark, f"{schema}.gold_pricing", GOLD_PRICING.format(schema=schema))


def daily_route_summary(spark: SparkSession, schema: str) -> DataFrame:
    """A-02: totals and average net revenue per route."""
    return sinks.create_view(spark, f"{schema}.vw_daily_route_summary", DAILY_ROUTE_SUMMARY.format(schema=schema))


def pricing_dashboard(spark: SparkSession, schema: str, region: str, top_n: int = 50) -> DataFrame:
    """A-03: the ``top_n`` routes of a region by adjusted price, with totals and delta."""
    sql = PRICING_DASHBOARD.format(schema=schema, region=region.replace("'", "''"), top_n=int(top_n))
    return sinks.create_view(spark, f"{schema}.vw_pricing_dashboard", sql)
