"""Usage and gateway queries (A-04, A-05, T-04, P-02, ST-02 batch, ST-04)."""

from __future__ import annotations

import datetime as dt

from sluice.functions.numeric import round_ratio_sql
from sluice.operators import usage as U
from sluice.plans.oracle import with_ctes
from sluice.plans.registry import register
from sluice.sources.tables import Tables

AS_OF = dt.datetime(2024, 2, 10)
# Driver data peaks at 2 calls per user-minute and 4 per minute overall, so the checked
# queries use limits that fire; production defaults are the gateway's 60 and 20.
CHECK_ENDPOINT_LIMIT = 2
CHECK_USER_LIMIT = 1

_DAILY_SQL = f"""
WITH d AS (
  SELECT CAST(request_time AS DATE) AS day, count(*) AS n, sum(execution_duration_ms) AS ms,
         count(execution_duration_ms) AS ms_n, sum(length(request) + length(response)) AS chars
  FROM payload WHERE request_time >= TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}' - INTERVAL 30 DAYS
  GROUP BY CAST(request_time AS DATE))
SELECT day, CAST(n AS BIGINT) AS pr_reviews,
       CASE WHEN ms_n > 0 THEN {round_ratio_sql('ms', 'ms_n * 1000', 1)} END AS avg_secs,
       CAST(round({round_ratio_sql('chars', '4', 0)}) AS BIGINT) AS est_tokens
FROM d"""


@register("usage_daily", with_ctes(["payload"], _DAILY_SQL), ids=("A-04", "P-02", "S-22", "S-06"))
def q_usage_daily(spark, sf_dir):
    return U.usage_daily(Tables(spark, sf_dir).payload, AS_OF)


_COST_SQL = f"""
WITH daily AS ({_DAILY_SQL}),
c AS (SELECT day, pr_reviews, est_tokens, ((est_tokens * 9) * 2 + 100) // 200 AS usd_e4 FROM daily)"""


@register("usage_cost", with_ctes(["payload"], _COST_SQL + """
SELECT day, pr_reviews, est_tokens, usd_e4, CAST(usd_e4 AS DOUBLE) / 10000.0 AS usd FROM c"""), ids=("A-05",))
def q_usage_cost(spark, sf_dir):
    return U.usage_cost(U.usage_daily(Tables(spark, sf_dir).payload, AS_OF))


@register("usage_cost_total", with_ctes(["payload"], _COST_SQL + f""",
t AS (SELECT CAST(coalesce(sum(pr_reviews), 0) AS BIGINT) AS total_reviews,
             CAST(coalesce(sum(usd_e4), 0) AS BIGINT) AS usd_e4 FROM c)
SELECT total_reviews, CAST(usd_e4 AS DOUBLE) / 10000.0 AS total_usd,
       CASE WHEN total_reviews > 0 THEN {round_ratio_sql('usd_e4', 'total_reviews * 10000', 4)} ELSE 0.0 END
         AS usd_per_review
FROM t"""), ids=("A-05",))
def q_usage_cost_total(spark, sf_dir):
    return U.usage_cost_total(U.usage_cost(U.usage_daily(Tables(spark, sf_dir).payload, AS_OF)))


@register("recent_requests", with_ctes(["payload"], f"""
SELECT request_id, request_time, requester, status_code,
       {round_ratio_sql('execution_duration_ms', '1000', 1)} AS secs
FROM payload ORDER BY request_time DESC, request_id DESC LIMIT 8"""), ids=("T-04",))
def q_recent_requests(spark, sf_dir):
    return U.recent_requests(Tables(spark, sf_dir).payload)


@register("rate_limit_breaches", with_ctes(["payload"], f"""
SELECT 'endpoint' AS key_type, endpoint AS key, date_trunc('minute', request_time) AS minute,
       CAST(count(*) AS BIGINT) AS calls, CAST({CHECK_ENDPOINT_LIMIT} AS INT) AS limit_per_minute
FROM payload GROUP BY endpoint, date_trunc('minute', request_time) HAVING count(*) > {CHECK_ENDPOINT_LIMIT}
UNION ALL
SELECT 'user', requester, date_trunc('minute', request_time), CAST(count(*) AS BIGINT),
       CAST({CHECK_USER_LIMIT} AS INT)
FROM payload GROUP BY requester, date_trunc('minute', request_time) HAVING count(*) > {CHECK_USER_LIMIT}"""),
          ids=("ST-02",))
def q_rate_limit_breaches(spark, sf_dir):
    return U.rate_limit_breaches(Tables(spark, sf_dir).payload, CHECK_ENDPOINT_LIMIT, CHECK_USER_LIMIT)


@register("pii_screen", f"""
SELECT doc_id, flags, CASE WHEN flags = '' THEN 'ALLOW' ELSE 'BLOCK' END AS action
FROM (SELECT doc_id, {U.pii_flags_sql('text')} AS flags FROM documents)""", ids=("ST-04",))
def q_pii_screen(spark, sf_dir):
    return U.pii_screen(Tables(spark, sf_dir).documents)
