"""Streaming queries (ST-01..ST-04) and their batch twins; streams drain with availableNow."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.numeric import round_ratio_sql
from sluice.operators import usage as U
from sluice.plans.oracle import with_ctes
from sluice.plans.q_rules import _LINES as _RULE_LINES
from sluice.plans.q_rules import _parse_sql
from sluice.plans.q_usage import CHECK_ENDPOINT_LIMIT, CHECK_USER_LIMIT
from sluice.plans.registry import register
from sluice.sources import tables as T
from sluice.streaming import streams as S

_USAGE_ALL = f"""
SELECT CAST(date_trunc('day', request_time) AS DATE) AS day, CAST(count(*) AS BIGINT) AS pr_reviews,
       CASE WHEN count(execution_duration_ms) > 0
            THEN {round_ratio_sql('sum(execution_duration_ms)', 'count(execution_duration_ms) * 1000', 1)} END
         AS avg_secs,
       CAST(round({round_ratio_sql('sum(length(request) + length(response))', '4', 0)}) AS BIGINT) AS est_tokens
FROM payload
GROUP BY date_trunc('day', request_time)"""
_USAGE_CLOSED = with_ctes(["payload"], _USAGE_ALL + """
HAVING date_trunc('day', request_time) + INTERVAL 1 DAY
       <= (SELECT max(request_time) FROM payload) - INTERVAL 1 hour""")


@register("stream_usage_daily", with_ctes(["payload"], _USAGE_ALL), ids=("ST-01",))
def q_stream_usage_daily(spark, sf_dir):
    return S.drain(T.payload_log(S.stream_table(spark, sf_dir, "events")), S.usage_daily_stream, ["day"], "usage_daily")


def _arrivals(spark, sf_dir, name: str, fixture, parts: list):
    """A folder that the rows of ``fixture`` reach in several arrivals: yields the stream after each, and its root."""
    root, rows = S.stream_root(spark, name), fixture(T.Tables(spark, sf_dir).events)
    for part in parts:
        rows.where(part).write.mode("append").parquet(f"{root}/in")
        yield spark.readStream.schema(rows.schema).parquet(f"{root}/in"), root


@register("stream_usage_resumed", with_ctes(["payload"], _USAGE_ALL), ids=("ST-01",))
def q_stream_usage_resumed(spark, sf_dir):
    # three runs of one stream, cut in the middle of days: each run amends the day that the last one left open
    day = F.dayofmonth("request_time")
    cut = [(day < 10) | ((day == 10) & (F.hour("request_time") < 13)), (day < 20) | ((day == 20) & (F.hour("request_time") < 5)), F.lit(True)]
    for stream, root in _arrivals(spark, sf_dir, "usage_resumed", T.payload_log, [cut[0], ~cut[0] & cut[1], ~cut[1]]):
        report = S.drain(stream, S.usage_daily_stream, ["day"], "usage_resumed", root=root)
    return report


@register("stream_payload_append", with_ctes(["payload"], "SELECT * FROM payload"), ids=("IO-13",))
def q_stream_payload_append(spark, sf_dir):
    # every third request is delivered again with the second arrival
    third = F.col("request_id") % 3 == 0
    for stream, root in _arrivals(spark, sf_dir, "payload", T.payload_log, [F.col("request_id") % 2 == 0, (F.col("request_id") % 2 == 1) | third]):
        log = S.append_payload(stream, root=root)
    return log


@register("usage_daily_closed", _USAGE_CLOSED, ids=("ST-01",))
def q_usage_daily_closed(spark, sf_dir):
    return S.usage_daily_closed(T.Tables(spark, sf_dir).payload)


_RATE_ALL = """
SELECT key_type, key, minute, CAST(count(*) AS BIGINT) AS calls, CAST(CASE WHEN key_type = 'endpoint' THEN 2 ELSE 1 END AS INT) AS limit_per_minute
FROM (SELECT 'endpoint' AS key_type, endpoint AS key, date_trunc('minute', request_time) AS minute FROM payload
      UNION ALL SELECT 'user', requester, date_trunc('minute', request_time) FROM payload)
GROUP BY key_type, key, minute
HAVING count(*) > CASE WHEN key_type = 'endpoint' THEN 2 ELSE 1 END"""
_RATE_CLOSED = with_ctes(["payload"], _RATE_ALL + """
   AND minute + INTERVAL 1 MINUTE <= (SELECT max(request_time) FROM payload) - INTERVAL 1 minute""")


@register("stream_rate_limit_breaches", with_ctes(["payload"], _RATE_ALL), ids=("ST-02",))
def q_stream_rate_limit_breaches(spark, sf_dir):
    payload = T.payload_log(S.stream_table(spark, sf_dir, "events"))
    return S.drain(payload, lambda p: S.rate_limit_stream(p, CHECK_ENDPOINT_LIMIT, CHECK_USER_LIMIT), S.RATE_KEYS, "rate_limits")


# a day of requests within a minute, from ten users: the real limits are passed
_BURSTS = """
SELECT key_type, key, minute, CAST(count(*) AS BIGINT) AS calls, CAST(CASE WHEN key_type = 'endpoint' THEN 60 ELSE 20 END AS INT) AS limit_per_minute
FROM (SELECT 'endpoint' AS key_type, event_type AS key, date_trunc('minute', make_timestamp(epoch_us(ts) // 1440)) AS minute FROM events
      UNION ALL SELECT 'user', concat('u', CAST(user_id % 10 AS VARCHAR)), date_trunc('minute', make_timestamp(epoch_us(ts) // 1440)) FROM events)
GROUP BY key_type, key, minute
HAVING count(*) > CASE WHEN key_type = 'endpoint' THEN 60 ELSE 20 END"""


@register("rate_limit_bursts", _BURSTS, ids=("ST-02",))
def q_rate_limit_bursts(spark, sf_dir):
    return U.rate_limit_breaches(T.payload_bursts(T.Tables(spark, sf_dir).events))


@register("stream_rate_limit_bursts", _BURSTS, ids=("ST-02",))
def q_stream_rate_limit_bursts(spark, sf_dir):
    # two runs, cut in the middle of a minute: the second one counts on
    first = F.col("request_id") <= T.Tables(spark, sf_dir).events.agg(F.floor(F.max("event_id") / 2)).scalar()
    for stream, root in _arrivals(spark, sf_dir, "bursts", T.payload_bursts, [first, ~first]):
        report = S.drain(stream, S.rate_limit_stream, S.RATE_KEYS, "bursts", root=root)
    return report


@register("rate_limit_closed", _RATE_CLOSED, ids=("ST-02",))
def q_rate_limit_closed(spark, sf_dir):
    return S.rate_limit_closed(T.Tables(spark, sf_dir).payload, CHECK_ENDPOINT_LIMIT, CHECK_USER_LIMIT)


@register("stream_index_sync", with_ctes(["rule_docs"], "WITH " + _RULE_LINES + ",\n" + _parse_sql() + """
SELECT doc_id, rule_id, CAST(0 AS BIGINT) AS epoch, 'insert' AS op, title FROM parsed WHERE doc_id % 40 <> 10
UNION ALL
SELECT doc_id, rule_id, CAST(1 AS BIGINT), CASE WHEN doc_id % 40 = 10 THEN 'insert' WHEN doc_id % 50 = 7 THEN 'delete' ELSE 'update' END,
       CASE WHEN doc_id % 40 <> 10 AND doc_id % 50 = 7 THEN title ELSE title || ' (v2)' END
FROM parsed WHERE doc_id % 40 = 10 OR doc_id % 50 = 7 OR doc_id % 30 = 0"""), ids=("ST-03",))
def q_stream_index_sync(spark, sf_dir):
    # two arrivals of the rule documents: most of them first; then the rest, some with a new title, some without their rule
    docs, root = T.Tables(spark, sf_dir).rule_docs, S.stream_root(spark, "index_sync")
    d = F.col("doc_id")
    later = F.when((d % 40 != 10) & (d % 50 == 7), F.lit("no rules here")).otherwise(F.regexp_replace("block", r"^(### [^\n]*)", "$1 (v2)"))
    arrivals = [docs.where(d % 40 != 10), docs.where((d % 40 == 10) | (d % 50 == 7) | (d % 30 == 0)).withColumn("block", later)]
    for rows in arrivals:
        rows.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        log = S.run_index_sync(stream, root=root)
    return log.select("doc_id", "rule_id", "epoch", "op", "title")


@register("stream_pii_screen", f"""
SELECT doc_id, flags, CASE WHEN flags = '' THEN 'ALLOW' ELSE 'BLOCK' END AS action
FROM (SELECT doc_id, {U.pii_flags_sql('text')} AS flags FROM documents)""", ids=("ST-04",))
def q_stream_pii_screen(spark, sf_dir):
    docs = S.stream_table(spark, sf_dir, "documents").select("doc_id", "text")
    return S.run_available(S.pii_screen_stream(docs), "pii_screen").select("doc_id", "flags", "action")
