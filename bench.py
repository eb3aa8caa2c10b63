"""Benchmark the headline queries: one JSON line with per-query seconds.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set). Each query runs its full plan
into the ``noop`` sink (nothing is collected to the driver); the time is the best of
BENCH_REPEAT runs (default 1), after every query has run once on the sf0.001 tables
(BENCH_WARMUP=0 skips that warm-up).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sluice.plans.registry import load_all  # noqa: E402
from sluice.session import get_session  # noqa: E402

WARMUP_DIR = "/root/testdata/sf0.001"
HEADLINE = [
    "daily_route_profitability", "route_revenue", "pricing_dashboard", "seasonal_prices", "price_adjustments",
    "usage_daily", "rate_limit_breaches", "pii_screen",
    "promotion_replay", "alias_metrics", "config_diff", "gate_decision",
    "diff_added_lines", "policy_scan", "decide_gate", "render_comment", "review_prompts",
    "parse_rules", "text_top_k", "vector_top_k", "parse_decisions", "parse_findings",
    "eval_scores", "demand_features", "stream_usage_daily",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app_name="sluice-bench")
    reg = load_all()
    # JVM warm-up (class loading, JIT of the regex / string / array paths) on the tiny
    # sf0.001 tables - never on the measured data
    if os.environ.get("BENCH_WARMUP", "1") == "1":
        for name in names:
            reg[name].fn(spark, WARMUP_DIR).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            reg[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None, "cpus": cpus}))


if __name__ == "__main__":
    main()
