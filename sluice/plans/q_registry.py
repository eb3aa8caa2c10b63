"""Registry and promotion queries (W-02..W-04, J-01, J-02, J-05, T-06, A-10..A-12, P-07..P-09, S-09, S-10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.numeric import round_ratio_sql
from sluice.functions.text import fixed_text_sql
from sluice.operators import registry as G
from sluice.plans.oracle import with_ctes
from sluice.plans.registry import register
from sluice.sources.tables import Tables

WIPE_ENVS = ("staging", "prod")

_VERSIONS = """versions AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY model_name, env ORDER BY start_time, run_id) AS INT) AS version
  FROM runs)"""
_REPLAY = """replay0 AS (
  SELECT v.*, min(CASE WHEN mae IS NOT NULL THEN {'m': mae, 'nv': -version} END) OVER (
           PARTITION BY model_name, env ORDER BY start_time, run_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
  FROM versions v),
replay AS (
  SELECT run_id, model_name, env, start_time, mae, max_acceptable_mae, n_estimators, max_depth, min_samples_leaf, features,
         version, best.m AS champion_mae, CAST(-best.nv AS INT) AS champion_version,
         CASE WHEN best IS NULL THEN 'APPROVE' WHEN mae IS NULL THEN 'BLOCK'
              WHEN mae <= best.m THEN 'APPROVE' ELSE 'BLOCK' END AS decision,
         CASE WHEN best IS NULL THEN 'bootstrap' WHEN mae IS NULL THEN 'missing_metric'
              WHEN mae <= best.m THEN 'no_regression' ELSE 'regression' END AS reason
  FROM replay0)"""
_EVENTS = """events_a AS (
  SELECT model_name, env, 'challenger' AS alias, version, start_time AS event_ts FROM replay
  UNION ALL
  SELECT model_name, env, 'champion', version, start_time FROM replay WHERE decision = 'APPROVE'),
state AS (
  SELECT model_name, env, alias, arg_max(version, {'t': event_ts, 'v': version}) AS version, max(event_ts) AS event_ts
  FROM events_a GROUP BY model_name, env, alias)"""


def _sql(body: str, *parts: str) -> str:
    return with_ctes(["runs"], "WITH " + ",\n".join(parts) + "\n" + body)


def _replay(spark, sf_dir):
    return G.promotion_replay(Tables(spark, sf_dir).runs)


@register("register_versions", _sql("SELECT run_id, model_name, env, version FROM versions", _VERSIONS),
          ids=("W-03",))
def q_register_versions(spark, sf_dir):
    return G.register_versions(Tables(spark, sf_dir).runs).select("run_id", "model_name", "env", "version")


@register("promotion_replay", _sql("""
SELECT run_id, model_name, env, version, mae, champion_mae, champion_version, decision, reason FROM replay""",
                                   _VERSIONS, _REPLAY), ids=("W-04", "S-10"))
def q_promotion_replay(spark, sf_dir):
    return _replay(spark, sf_dir).select(
        "run_id", "model_name", "env", "version", "mae", "champion_mae", "champion_version", "decision", "reason")


@register("alias_state", _sql("SELECT model_name, env, alias, version, event_ts FROM state",
                              _VERSIONS, _REPLAY, _EVENTS), ids=("W-02",))
def q_alias_state(spark, sf_dir):
    return G.alias_state(G.alias_events(_replay(spark, sf_dir))).select("model_name", "env", "alias", "version", "event_ts")


@register("alias_metrics", _sql("""
SELECT k.model_name, k.env, k.alias, s.version, v.run_id, v.mae,
       CASE WHEN s.version IS NULL THEN 'none' ELSE 'found' END AS status
FROM (SELECT DISTINCT model_name, env, unnest(['challenger', 'champion']) AS alias FROM versions) k
LEFT JOIN state s ON k.model_name = s.model_name AND k.env = s.env AND k.alias = s.alias
LEFT JOIN versions v ON k.model_name = v.model_name AND k.env = v.env AND s.version = v.version""",
                                _VERSIONS, _REPLAY, _EVENTS), ids=("J-01",))
def q_alias_metrics(spark, sf_dir):
    return G.alias_metrics(G.alias_state(G.alias_events(_replay(spark, sf_dir))))


@register("latest_run", with_ctes(["runs"], """
SELECT model_name, arg_max(run_id, {'t': start_time, 'r': run_id}) AS run_id, max(start_time) AS start_time
FROM runs GROUP BY model_name"""), ids=("T-06",))
def q_latest_run(spark, sf_dir):
    return G.latest_run(Tables(spark, sf_dir).runs)


@register("latest_version", _sql("""
SELECT model_name, env, max(version) AS latest_version FROM versions GROUP BY model_name, env""", _VERSIONS),
          ids=("A-11",))
def q_latest_version(spark, sf_dir):
    return G.latest_version(Tables(spark, sf_dir).runs)


def _cmp_sql() -> str:
    delta = "(mae - champion_mae)"
    pct = f"(CASE WHEN champion_mae <> 0 THEN {delta} / champion_mae * 100 ELSE 0.0 END)"
    return f"""
SELECT model_name, env, version, {delta} AS delta, {pct} AS pct_change, mae <= champion_mae AS better,
       'Challenger MAE: ' || {fixed_text_sql('mae', 4)} || ' vs Champion MAE: ' || {fixed_text_sql('champion_mae', 4)}
       || ' - ' || CASE WHEN mae <= champion_mae
            THEN 'improved by ' || {fixed_text_sql(f'abs({delta})', 4)} || ' (' || {fixed_text_sql(f'abs({pct})', 1)} || '%)'
            ELSE 'degraded by ' || {fixed_text_sql(delta, 4)} || ' (' || {fixed_text_sql(pct, 1)}
                 || '%) - BLOCKER unless justified' END AS summary
FROM replay WHERE champion_mae IS NOT NULL AND mae IS NOT NULL"""


@register("compare_metrics", _sql(_cmp_sql(), _VERSIONS, _REPLAY), ids=("S-09",))
def q_compare_metrics(spark, sf_dir):
    replay = _replay(spark, sf_dir).where(F.col("champion_mae").isNotNull() & F.col("mae").isNotNull())
    return G.compare_metrics(replay).select("model_name", "env", "version", "delta", "pct_change", "better",
                                            "summary")


_PARAMS = """params AS (
  SELECT run_id, unnest(['n_estimators', 'max_depth', 'min_samples_leaf', 'features', 'max_acceptable_mae']) AS key,
         unnest([CAST(n_estimators AS VARCHAR), CAST(max_depth AS VARCHAR), CAST(min_samples_leaf AS VARCHAR), features,
                 CAST(max_acceptable_mae AS VARCHAR)]) AS value
  FROM runs),
pairs AS (
  SELECT r.model_name, r.env, r.version, r.run_id, c.run_id AS champion_run_id
  FROM replay r JOIN versions c ON r.model_name = c.model_name AND r.env = c.env AND r.champion_version = c.version),
diff AS (
  SELECT coalesce(a.model_name, b.model_name) AS model_name, coalesce(a.env, b.env) AS env,
         coalesce(a.version, b.version) AS version, coalesce(a.key, b.key) AS key,
         b.value AS old_value, a.value AS new_value,
         CASE WHEN b.value IS NULL AND a.value IS NOT NULL THEN 'added'
              WHEN a.value IS NULL AND b.value IS NOT NULL THEN 'removed'
              WHEN a.value IS DISTINCT FROM b.value THEN 'changed' END AS change
  FROM (SELECT p.model_name, p.env, p.version, x.key, x.value FROM pairs p JOIN params x ON p.run_id = x.run_id) a
  FULL OUTER JOIN (SELECT p.model_name, p.env, p.version, x.key, x.value
                   FROM pairs p JOIN params x ON p.champion_run_id = x.run_id) b
    ON a.model_name = b.model_name AND a.env = b.env AND a.version = b.version AND a.key = b.key)"""


@register("config_diff", _sql("""
SELECT model_name, env, version, key, old_value, new_value, change FROM diff WHERE change IS NOT NULL""",
                              _VERSIONS, _REPLAY, _PARAMS), ids=("J-02",))
def q_config_diff(spark, sf_dir):
    return G.config_diff(_replay(spark, sf_dir))


@register("config_sync_check", _sql("""
SELECT model_name, env, version, hp_changed, threshold_changed, 'ML-01' AS rule_id, 'BLOCKER' AS severity,
       'Hyperparameters changed without an updated max_acceptable_mae' AS message
FROM (SELECT model_name, env, version,
             bool_or(key IN ('n_estimators', 'max_depth', 'min_samples_leaf', 'features')) AS hp_changed,
             bool_or(key = 'max_acceptable_mae') AS threshold_changed
      FROM diff WHERE change IS NOT NULL GROUP BY model_name, env, version)
WHERE hp_changed AND NOT threshold_changed""", _VERSIONS, _REPLAY, _PARAMS), ids=("J-05",))
def q_config_sync_check(spark, sf_dir):
    return G.config_sync_of(_replay(spark, sf_dir))


@register("mae_within_threshold", with_ctes(["runs"], """
SELECT run_id, mae, max_acceptable_mae, mae <= max_acceptable_mae AS mae_within_threshold FROM runs"""),
          ids=("P-07",))
def q_mae_within_threshold(spark, sf_dir):
    return G.mae_within_threshold(Tables(spark, sf_dir).runs)


@register("config_validity", with_ctes(["runs"], """
SELECT config_id, split_part(f, ':', 1) AS "check", split_part(f, ':', 2) AS field
FROM (SELECT run_id AS config_id, unnest([
        CASE WHEN n_estimators IS NULL THEN 'missing:n_estimators' WHEN n_estimators <= 0 THEN 'non_positive:n_estimators' END,
        CASE WHEN max_depth IS NULL THEN 'missing:max_depth' WHEN max_depth <= 0 THEN 'non_positive:max_depth' END,
        CASE WHEN min_samples_leaf IS NULL THEN 'missing:min_samples_leaf'
             WHEN min_samples_leaf <= 0 THEN 'non_positive:min_samples_leaf' END,
        CASE WHEN features IS NULL THEN 'empty:features' END,
        CASE WHEN max_acceptable_mae IS NULL THEN 'missing:max_acceptable_mae'
             WHEN max_acceptable_mae <= 0 THEN 'non_positive:max_acceptable_mae' END]) AS f
      FROM runs)
WHERE f IS NOT NULL"""), ids=("P-08",))
def q_config_validity(spark, sf_dir):
    return G.config_validity(G.config_table(Tables(spark, sf_dir).runs))


def _requests(events):
    k = F.get_json_object("props", "$.k").cast("int")
    env = F.when(F.col("user_id") % 3 == 0, "dev").when(F.col("user_id") % 3 == 1, "staging").otherwise("prod")
    return events.select(F.col("event_id").alias("request_id"), F.col("event_type").alias("model_name"),
                         env.alias("env"),
                         F.when(k % 2 == 0, (k % 40 + 1).cast("string")).otherwise(F.lit("@prod")).alias("requested"))


@register("resolve_version", _sql("""
SELECT q.request_id, q.model_name, q.env, q.requested,
       CASE WHEN regexp_matches(q.requested, '^[0-9]+$') THEN TRY_CAST(q.requested AS INT) ELSE s.version END AS version,
       CASE WHEN regexp_matches(q.requested, '^[0-9]+$') THEN 'pinned' ELSE 'alias' END AS resolved_by
FROM (SELECT event_id AS request_id, event_type AS model_name,
             CASE user_id % 3 WHEN 0 THEN 'dev' WHEN 1 THEN 'staging' ELSE 'prod' END AS env,
             CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) % 2 = 0
                  THEN CAST(CAST(json_extract_string(props, '$.k') AS INT) % 40 + 1 AS VARCHAR) ELSE '@prod' END
               AS requested
      FROM events) q
LEFT JOIN (SELECT * FROM state WHERE alias = 'champion') s ON q.model_name = s.model_name AND q.env = s.env""",
                                  _VERSIONS, _REPLAY, _EVENTS), ids=("P-09",))
def q_resolve_version(spark, sf_dir):
    t = Tables(spark, sf_dir)
    state = G.alias_state(G.alias_events(_replay(spark, sf_dir)))
    return G.resolve_version(_requests(t.events), state)


@register("registry_retention", _sql("""
SELECT model_name, env, min(version) AS version, 'keep_as_champion' AS action FROM versions
WHERE env NOT IN ('staging', 'prod') GROUP BY model_name, env
UNION ALL
SELECT v.model_name, v.env, v.version, 'delete' FROM versions v
WHERE NOT EXISTS (SELECT 1 FROM (SELECT model_name, env, min(version) AS version FROM versions
                                 WHERE env NOT IN ('staging', 'prod') GROUP BY model_name, env) k
                  WHERE k.model_name = v.model_name AND k.env = v.env AND k.version = v.version)""",
                                     _VERSIONS), ids=("A-10",))
def q_registry_retention(spark, sf_dir):
    return G.registry_retention(G.register_versions(Tables(spark, sf_dir).runs), WIPE_ENVS)


@register("mae_by_run", f"""
SELECT run_id, CAST(n AS BIGINT) AS n, {round_ratio_sql('e', 'n * 100', 6)} AS mae
FROM (SELECT run_id, sum(CAST(abs((y - yhat) * 100) AS HUGEINT)) AS e, count(*) AS n
      FROM (SELECT user_id % 7 AS run_id, CAST(value AS DECIMAL(18,2)) AS y,
                   CAST(json_extract_string(props, '$.k') AS DECIMAL(18,2)) AS yhat FROM events)
      GROUP BY run_id)""", ids=("A-12",))
def q_mae_by_run(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    preds = ev.select((F.col("user_id") % 7).alias("run_id"), F.col("value").cast("decimal(18,2)").alias("y"),
                      F.get_json_object("props", "$.k").cast("decimal(18,2)").alias("yhat"))
    return G.mae_by_run(preds)
