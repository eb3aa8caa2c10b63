"""Usage, cost, rate-limit and input-screen reports over the inference payload log.

All of them are aggregations or projections over the append-only log; the same
functions run on a batch DataFrame and on a streaming one (see ``sluice.streaming``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.numeric import round_ratio, round_ratio_units

# Illustrative token price and the gateway rate limits.
USD_PER_1K_TOKENS = 0.009
ENDPOINT_CALLS_PER_MINUTE = 60
USER_CALLS_PER_MINUTE = 20
CHARS_PER_TOKEN = 4
WINDOW_DAYS = 30

# Personal-data and secret patterns screened at the gateway input (action BLOCK).
# Plain RE2/Java-compatible syntax: no lookaround, no back references.
PII_PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    ("ipv4", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"),
    ("long_number", r"[0-9]{13,19}"),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    ("phone", r"\+[0-9]{1,3}[ -][0-9]{2,4}[ -][0-9]{3,4}[ -][0-9]{3,4}"),
    ("secret", r"(api[_-]?key|secret|password|passwd|token)[ \t]*[:=]"),
]
LOWERCASE_PATTERNS = {"secret"}
# A literal every match of the pattern contains: a cheap substring test skips the regex.
REQUIRED_LITERALS = {"email": ["@"], "ssn": ["-"], "phone": ["+"], "secret": [":", "="]}


def as_timestamp_ntz(value: dt.datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def within_last_days(ts_col: str, as_of, days: int = WINDOW_DAYS) -> Column:
    """P-02: ``ts >= as_of - INTERVAL days DAYS`` with an explicit ``as_of``."""
    return F.col(ts_col) >= as_timestamp_ntz(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def usage_measures() -> list[Column]:
    """Aggregates of the usage report, for a batch or a stream."""
    return [F.count(F.lit(1)).alias("pr_reviews"), F.sum("execution_duration_ms").alias("_ms"), F.count("execution_duration_ms").alias("_ms_n"),
            F.sum(F.length("request") + F.length("response")).alias("_chars")]


def usage_columns(day: Column) -> list[Column]:
    """Requests, average seconds (1 dp) and estimated tokens (chars / 4) from the measures."""
    return [day.alias("day"), F.col("pr_reviews").cast("bigint").alias("pr_reviews"),
            F.when(F.col("_ms_n") > 0, round_ratio("_ms", F.col("_ms_n") * 1000, 1)).alias("avg_secs"),
            round_ratio_units("_chars", F.lit(CHARS_PER_TOKEN)).alias("est_tokens")]


def usage_daily(payload: DataFrame, as_of, days: int = WINDOW_DAYS) -> DataFrame:
    """A-04: the usage report per day of the last ``days`` days."""
    recent = payload.where(within_last_days("request_time", as_of, days))
    return recent.groupBy(F.col("request_time").cast("date").alias("day")).agg(*usage_measures()).select(*usage_columns(F.col("day")))


def usage_cost(daily: DataFrame) -> DataFrame:
    """A-05: illustrative USD per day, rounded to 4 dp (token price per 1k tokens)."""
    # usd = tokens / 1000 * 0.009 = tokens * 9 / 1e6; kept in ten-thousandths as an integer
    return daily.select(
        "day", "pr_reviews", "est_tokens",
        round_ratio_units(F.col("est_tokens") * 9, F.lit(100)).alias("usd_e4"),
    ).withColumn("usd", F.col("usd_e4").cast("double") / 10000.0)


def usage_cost_total(cost: DataFrame) -> DataFrame:
    """A-05: totals over the rounded days and cost per review (0 without reviews)."""
    t = cost.agg(F.coalesce(F.sum("pr_reviews"), F.lit(0)).cast("bigint").alias("total_reviews"),
                 F.coalesce(F.sum("usd_e4"), F.lit(0)).cast("bigint").alias("_usd_e4"))
    return t.select(
        "total_reviews",
        (F.col("_usd_e4").cast("double") / 10000.0).alias("total_usd"),
        F.when(F.col("total_reviews") > 0, round_ratio("_usd_e4", F.col("total_reviews") * 10000, 4))
        .otherwise(F.lit(0.0)).alias("usd_per_review"),
    )


def recent_requests(payload: DataFrame, n: int = 8) -> DataFrame:
    """T-04: the ``n`` most recent requests (ties by request id)."""
    return (
        payload.orderBy(F.desc("request_time"), F.desc("request_id")).limit(n)
        .select("request_id", "request_time", "requester", "status_code",
                round_ratio("execution_duration_ms", F.lit(1000), 1).alias("secs"))
    )


def _minute(ts: str) -> Column:
    return F.date_trunc("minute", F.col(ts))


def rate_limit_breaches(payload: DataFrame, endpoint_limit: int = ENDPOINT_CALLS_PER_MINUTE,
                        user_limit: int = USER_CALLS_PER_MINUTE) -> DataFrame:
    """ST-02 (batch): minutes where an endpoint or a user exceeded its calls-per-minute limit."""
    by_endpoint = (payload.groupBy(F.col("endpoint").alias("key"), _minute("request_time").alias("minute"))
                   .agg(F.count(F.lit(1)).alias("calls"))
                   .where(F.col("calls") > endpoint_limit)
                   .select(F.lit("endpoint").alias("key_type"), "key", "minute",
                           F.col("calls").cast("bigint").alias("calls"),
                           F.lit(endpoint_limit).cast("int").alias("limit_per_minute")))
    by_user = (payload.groupBy(F.col("requester").alias("key"), _minute("request_time").alias("minute"))
               .agg(F.count(F.lit(1)).alias("calls"))
               .where(F.col("calls") > user_limit)
               .select(F.lit("user").alias("key_type"), "key", "minute",
                       F.col("calls").cast("bigint").alias("calls"),
                       F.lit(user_limit).cast("int").alias("limit_per_minute")))
    return by_endpoint.unionByName(by_user)


def pii_flags(text: Column) -> Column:
    """Comma-separated names of the screen patterns found in ``text`` ('' when clean)."""
    lowered = F.lower(text)
    parts = []
    for name, p in PII_PATTERNS:
        hit = (lowered if name in LOWERCASE_PATTERNS else text).rlike(p)
        lits = REQUIRED_LITERALS.get(name)
        if lits:
            pre = text.contains(lits[0])
            for lit in lits[1:]:
                pre = pre | text.contains(lit)
            hit = pre & hit  # And short-circuits: the regex only runs when the literal is present
        parts.append(F.when(hit, F.lit(name)))
    return F.concat_ws(",", *parts)


def pii_screen(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """ST-04: flag rows whose text carries personal data or secrets; action BLOCK/ALLOW."""
    flags = pii_flags(F.col(text_col))
    return df.select(
        F.col(id_col), flags.alias("flags"),
    ).select(
        id_col, "flags",
        F.when(F.col("flags") == "", "ALLOW").otherwise("BLOCK").alias("action"),
    )


def pii_flags_sql(text: str) -> str:
    parts = []
    for name, p in PII_PATTERNS:
        subject = f"lower({text})" if name in LOWERCASE_PATTERNS else text
        parts.append(f"CASE WHEN regexp_matches({subject}, '{p}') THEN '{name}' END")
    return "concat_ws(',', " + ", ".join(parts) + ")"
