"""Reviewer evaluation queries (S-21 cases, A-07..A-09) and promotion gate tables (S-13, ML-D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators import diffs as D
from sluice.operators import evals as E
from sluice.operators import promotion as P
from sluice.operators import registry as G
from sluice.operators import review as V
from sluice.operators import rules as RL
from sluice.plans.oracle import with_ctes
from sluice.plans.q_diffs import _lang_sql, q, rule_hits_sql
from sluice.plans.q_registry import _REPLAY, _VERSIONS
from sluice.plans.registry import register
from sluice.sources.tables import Tables


def _cases(t: Tables):
    """Eval cases: labelled documents as added-file diffs; expectations from the lines that were put into them."""
    files = t.change_files.select("doc_id", "path", "text").join(t.labels.select("doc_id").distinct(), "doc_id", "left_semi")
    k, python = F.col("doc_id") % 13, F.col("doc_id") % 4 == 0
    return files.select(
        F.col("doc_id").alias("case_id"), D.as_added_diff(F.col("path"), F.col("text")).alias("diff"), (k == 3).alias("has_cross_env"),
        (k.isin(0, 6) & python).alias("has_transform_issue"), k.isin(10, 11, 12).alias("is_clean"))


def _scored(t: Tables):
    """Cases with the rules that their diffs meet, in one pass over the documents."""
    cases = D.parsed_diffs(_cases(t), keep=("case_id", "has_cross_env", "has_transform_issue", "is_clean"))
    return E.score_cases(cases.withColumn("rules", V.rules_met(F.col("files"))))


def _case_findings(cases):
    files = D.diff_files(cases, "diff", key_cols=("case_id",))
    return V.policy_scan(D.diff_added_lines(files, key_cols=("case_id",)), key_cols=("case_id",))


_CASES = f"""cases AS (
  SELECT c.doc_id AS case_id, c.doc_id % 13 = 3 AS has_cross_env, c.doc_id % 13 IN (0, 6) AND c.doc_id % 4 = 0 AS has_transform_issue,
         c.doc_id % 13 IN (10, 11, 12) AS is_clean, c.path, {_lang_sql('c.path')} AS language, c.text
  FROM change_files c WHERE c.doc_id IN (SELECT doc_id FROM labels)),
clines AS (SELECT case_id, language, unnest(string_split(text, chr(10))) AS text FROM cases),
cfind AS ({rule_hits_sql('clines', 'case_id')}),
scores AS (
  SELECT c.case_id,
         coalesce(x.env01, false) = c.has_cross_env AS caught_cross_env_ref,
         coalesce(x.tp, false) = c.has_transform_issue AS flagged_transform_violation,
         (NOT c.is_clean) OR coalesce(x.n, 0) = 0 AS zero_false_positives_on_clean_code
  FROM cases c LEFT JOIN (SELECT case_id, bool_or(rule_id = 'ENV-01') AS env01,
                                 bool_or(starts_with(rule_id, 'TP-')) AS tp, count(*) AS n
                          FROM cfind GROUP BY case_id) x ON c.case_id = x.case_id)"""


def _sql(body: str) -> str:
    return with_ctes(["change_files"], "WITH " + _CASES + "\n" + body)


@register("eval_scores", _sql("SELECT * FROM scores"), ids=("A-08", "A-07", "S-21"))
def q_eval_scores(spark, sf_dir):
    return _scored(Tables(spark, sf_dir))


@register("eval_scores_joined", _sql("SELECT * FROM scores"), ids=("J-06", "A-08"))
def q_eval_scores_joined(spark, sf_dir):
    cases = _cases(Tables(spark, sf_dir))
    return E.eval_scores(cases, _case_findings(cases))


@register("eval_gate", _sql("""
SELECT scorer, mean, coalesce(mean, 0.0) >= 1.0 AS passed FROM (
  SELECT 'caught_cross_env_ref' AS scorer, avg(CAST(caught_cross_env_ref AS DOUBLE)) AS mean FROM scores
  UNION ALL SELECT 'flagged_transform_violation', avg(CAST(flagged_transform_violation AS DOUBLE)) FROM scores
  UNION ALL SELECT 'zero_false_positives_on_clean_code', avg(CAST(zero_false_positives_on_clean_code AS DOUBLE))
  FROM scores)"""), ids=("A-09",))
def q_eval_gate(spark, sf_dir):
    return E.eval_gate(_scored(Tables(spark, sf_dir)))


def _metric_map(prefix: str = ""):
    return F.create_map(
        F.lit("mae"), F.col(f"{prefix}mae").cast("string"),
        F.lit("mae_within_threshold"), F.when(F.col(f"{prefix}mae") <= F.col(f"{prefix}max_acceptable_mae"),
                                              F.lit("1.0")).otherwise(F.lit("0.0")),
        F.lit("max_acceptable_mae"), F.col(f"{prefix}max_acceptable_mae").cast("string"))


def _gate_cases(t: Tables):
    replay = G.promotion_replay(t.runs)
    keys, old, new = F.array_sort(F.array_union(F.map_keys("champion_params"), F.map_keys("params"))), "champion_params", "params"
    changed = F.filter(keys, lambda k: ~F.try_element_at(old, k).eqNullSafe(F.try_element_at(new, k)))
    none = F.lit("(none)")
    diff = F.array_join(F.transform(changed, lambda k: F.concat(
        k, F.lit(": "), F.coalesce(F.try_element_at(old, k), none), F.lit(" -> "), F.coalesce(F.try_element_at(new, k), none))), "\n")
    staged = replay.withColumn("config_diff", diff)
    return staged.select(
        "model_name", "env", "version", _metric_map().alias("challenger_metrics"),
        F.when(F.col("champion_run_id").isNotNull(), _metric_map("champion_")).alias("champion_metrics"),
        "config_diff", F.col("mae").alias("challenger_mae"), F.col("champion_mae"),
        (F.col("max_depth") == 8).alias("justified"))


_METRICS_SQL = """coalesce('  mae: ' || CAST({p}mae AS VARCHAR) || chr(10), '') || '  mae_within_threshold: '
    || CASE WHEN {p}mae <= {p}max_acceptable_mae THEN '1.0' ELSE '0.0' END || chr(10)
    || '  max_acceptable_mae: ' || CAST({p}max_acceptable_mae AS VARCHAR)"""


@register("promotion_prompts", with_ctes(["runs", "handbook"], "WITH " + _VERSIONS + ",\n" + _REPLAY + r""",
params AS (
  SELECT run_id, unnest(['n_estimators', 'max_depth', 'min_samples_leaf', 'features', 'max_acceptable_mae']) AS key,
         unnest([CAST(n_estimators AS VARCHAR), CAST(max_depth AS VARCHAR), CAST(min_samples_leaf AS VARCHAR), features,
                 CAST(max_acceptable_mae AS VARCHAR)]) AS value FROM runs),
pairs AS (
  SELECT r.*, c.run_id AS champion_run_id, c.mae AS c_mae, c.max_acceptable_mae AS c_max_acceptable_mae
  FROM replay r LEFT JOIN versions c ON r.model_name = c.model_name AND r.env = c.env AND r.champion_version = c.version),
dt AS (
  SELECT p.model_name, p.env, p.version,
         string_agg(a.key || ': ' || coalesce(b.value, '(none)') || ' -> ' || coalesce(a.value, '(none)'), chr(10)
                    ORDER BY a.key) FILTER (WHERE a.value IS DISTINCT FROM b.value) AS config_diff
  FROM pairs p JOIN params a ON a.run_id = p.run_id LEFT JOIN params b ON b.run_id = p.champion_run_id AND b.key = a.key
  WHERE p.champion_run_id IS NOT NULL GROUP BY p.model_name, p.env, p.version)
SELECT p.model_name, p.env, p.version, """ + q(P.GATE_SYSTEM) + r""" AS system,
       'RULES' || chr(10) || (SELECT '- ' || rule_id || ' [' || severity_hint || '] (Citation: '
            || CASE WHEN doc_id % 5 = 4 THEN 'Handbook › ML Model Lifecycle › ' || rule_id ELSE citation END || '): '
            || regexp_replace(string_agg(x, ' ' ORDER BY n), '^\s+|\s+$', '', 'g')
          FROM (SELECT *, generate_subscripts(string_split(text, chr(10)), 1) AS n,
                       unnest(list_transform(string_split(text, chr(10)), lambda l: regexp_replace(l, '^\s+|\s+$', '', 'g'))) AS x
                FROM handbook WHERE doc_id = (SELECT min(doc_id) FROM handbook))
          WHERE x <> '' GROUP BY doc_id, rule_id, severity_hint, citation)
       || chr(10) || chr(10) || 'CHAMPION' || chr(10)
       || CASE WHEN p.champion_run_id IS NULL THEN '""" + P.NO_CHAMPION_BLOCK + """' ELSE """
    + _METRICS_SQL.format(p="c_") + """ END
       || chr(10) || chr(10) || 'CHALLENGER' || chr(10) || """ + _METRICS_SQL.format(p="") + """
       || chr(10) || chr(10) || 'CONFIG CHANGES' || chr(10)
       || coalesce(nullif(d.config_diff, ''), '""" + P.NO_CONFIG_DIFF + """') || chr(10) || chr(10)
       || 'Answer with the decision as JSON.' AS prompt
FROM pairs p LEFT JOIN dt d ON p.model_name = d.model_name AND p.env = d.env AND p.version = d.version"""),
          ids=("S-13", "S-23"))
def q_promotion_prompts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # the rules of the first handbook document: one text for all prompts
    book = RL.rules_text(t.handbook, P.DEFAULT_ML_RULES)
    rules = book.agg(F.min_by("rules_text", "doc_id")).scalar()
    return P.promotion_prompts(_gate_cases(t), rules).select("model_name", "env", "version", "system", "prompt")


@register("gate_decision", with_ctes(["runs"], "WITH " + _VERSIONS + ",\n" + _REPLAY + """
SELECT model_name, env, version,
       CASE WHEN mae IS NULL THEN 'BLOCK' WHEN champion_mae IS NULL THEN 'APPROVE'
            WHEN mae <= champion_mae OR max_depth = 8 THEN 'APPROVE' ELSE 'BLOCK' END AS decision,
       CASE WHEN champion_mae IS NOT NULL AND mae IS NOT NULL AND NOT (mae <= champion_mae) THEN 'ML-03' END
         AS finding_rule,
       champion_mae IS NULL AS bootstrap
FROM replay"""), ids=("ML-D", "S-10", "S-09"))
def q_gate_decision(spark, sf_dir):
    d = P.gate_decision(_gate_cases(Tables(spark, sf_dir)))
    return d.select("model_name", "env", "version", "decision", F.col("finding.rule_id").alias("finding_rule"),
                    F.col("champion_mae").isNull().alias("bootstrap"))
