"""Reviewer evaluation: scorers per case and the 100%-per-scorer regression gate.

A case is scored within its row where its diff is at hand (``score_cases``); findings that come from
elsewhere are joined to the cases (``eval_scores``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCORERS = ("caught_cross_env_ref", "flagged_transform_violation", "zero_false_positives_on_clean_code")


def has_rule(rule_id: str):
    """A-07: aggregate - some finding carries exactly ``rule_id``."""
    return F.coalesce(F.bool_or(F.col("rule_id") == rule_id), F.lit(False))


def has_rule_prefix(prefix: str):
    """A-07: aggregate - some finding's rule id starts with ``prefix``."""
    return F.coalesce(F.bool_or(F.col("rule_id").startswith(prefix)), F.lit(False))


def eval_scores(cases: DataFrame, findings: DataFrame, key: str = "case_id") -> DataFrame:
    """A-08: per case the three pass/fail scores (predictions joined to expectations)."""
    per = findings.groupBy(key).agg(has_rule("ENV-01").alias("has_env01"), has_rule_prefix("TP-").alias("has_tp"),
                                    F.count(F.lit(1)).alias("n_findings"))
    j = cases.join(per, key, "left").fillna({"has_env01": False, "has_tp": False, "n_findings": 0})
    return j.select(
        key,
        (F.col("has_env01") == F.coalesce(F.col("has_cross_env"), F.lit(False))).alias(SCORERS[0]),
        (F.col("has_tp") == F.coalesce(F.col("has_transform_issue"), F.lit(False))).alias(SCORERS[1]),
        (~F.coalesce(F.col("is_clean"), F.lit(False)) | (F.col("n_findings") == 0)).alias(SCORERS[2]),
    )


def met(rule_id: str, rules=F.col) -> Column:
    """A-07 on an array of rule ids: ``rule_id`` is among them."""
    return F.array_contains(rules("rules"), rule_id)


def met_prefix(prefix: str, rules=F.col) -> Column:
    """A-07 on an array of rule ids: one of them starts with ``prefix``."""
    return F.exists(rules("rules"), lambda r: r.startswith(prefix))


def score_cases(cases: DataFrame, key: str = "case_id") -> DataFrame:
    """A-08 within the row: ``cases`` has the expectations and ``rules``, the ids of the rules that its diff meets."""
    expected = lambda c: F.coalesce(F.col(c), F.lit(False))
    return cases.select(
        key, (met("ENV-01") == expected("has_cross_env")).alias(SCORERS[0]), (met_prefix("TP-") == expected("has_transform_issue")).alias(SCORERS[1]),
        (~expected("is_clean") | (F.size("rules") == 0)).alias(SCORERS[2]))


def eval_gate(scores: DataFrame) -> DataFrame:
    """A-09: mean of each scorer; the gate fails unless every mean is 1.0 (no cases = fail)."""
    means = scores.agg(*[F.avg(F.col(s).cast("double")).alias(s) for s in SCORERS])
    stacked = means.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("scorer"), F.col(s).alias("mean")) for s in SCORERS])).alias("_s"))
    return stacked.select("_s.scorer", "_s.mean",
                          (F.coalesce(F.col("_s.mean"), F.lit(0.0)) >= 1.0).alias("passed"))
