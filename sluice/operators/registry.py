"""Model registry and promotion jobs over tables of training runs.

Runs become numbered versions, aliases are an append-only event table whose current
state is the latest event per (model, env, alias), and the promotion gate is replayed
over the whole history with the rule "challenger MAE <= champion MAE" (bootstrap
approves the first version). Versions and champions are scanned in ranges of the start
time, so a model with most of the history is still split across tasks.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.scan import grouped_row_number, running
from sluice.functions.text import fixed_text
from sluice.session import sized_broadcast

MODEL_KEY = ["model_name", "env"]
HYPERPARAMETERS = ("n_estimators", "max_depth", "min_samples_leaf")
THRESHOLD_KEY = "max_acceptable_mae"
FEATURES_KEY = "features"
CONFIG_KEYS = (*HYPERPARAMETERS, FEATURES_KEY, THRESHOLD_KEY)


def _start_us(col: str = "start_time") -> Column:
    return F.unix_micros(F.col(col).cast("timestamp"))


def register_versions(runs: DataFrame) -> DataFrame:
    """W-03: version = 1, 2, ... per (model, env) in (start_time, run_id) order."""
    staged = runs.withColumn("_t", _start_us())
    return grouped_row_number(staged, MODEL_KEY, ["_t", "run_id"], name="version").drop("_t")


def params_map(value=F.col) -> Column:
    """A run's configuration as a MAP<STRING,STRING>; keys without a value are absent."""
    keys = CONFIG_KEYS
    full = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[value(k).cast("string") for k in keys]))
    return F.map_filter(full, lambda k, v: v.isNotNull())


def promotion_replay(runs: DataFrame, partitions: int | None = None) -> DataFrame:
    """W-03 + W-04 + S-10: number the versions and replay the gate, one shuffle of the runs.

    Under the strict rule the champion before a version is the latest earlier run holding
    the running minimum MAE. The scan carries that run's id, number and configuration
    along, so nothing is looked up afterwards; a hot model spreads over many partitions.
    Accepts runs with or without a ``version`` column (an existing one is recomputed).
    """
    keep = [c for c in runs.columns if c != "version"]
    scanned = running(runs.select(*keep).withColumn("_t", _start_us()), MODEL_KEY, ["_t", "run_id"], number="version", least="mae",
                      keep=("mae", "run_id", *CONFIG_KEYS), found="_best", partitions=partitions)
    champion, mae = F.col("_best.mae"), F.col("mae")
    reason = (F.when(F.col("_best").isNull(), "bootstrap").when(mae.isNull(), "missing_metric")
              .when(mae <= champion, "no_regression").otherwise("regression"))
    return scanned.select(
        *keep, F.col("version").cast("int").alias("version"), champion.alias("champion_mae"),
        F.col("_best.run_id").alias("champion_run_id"), F.col("_best._number").cast("int").alias("champion_version"),
        F.col(f"_best.{THRESHOLD_KEY}").alias(f"champion_{THRESHOLD_KEY}"),
        F.when(F.col("_best").isNotNull(), F.struct(*[F.col(f"_best.{k}").alias(k) for k in CONFIG_KEYS])).alias("champion_config"),
        F.when(F.col("_best").isNotNull(), params_map(lambda k: F.col(f"_best.{k}"))).alias("champion_params"),
        params_map().alias("params"), reason.alias("reason"),
        F.when(reason.isin("bootstrap", "no_regression"), "APPROVE").otherwise("BLOCK").alias("decision"))


def alias_events(replay: DataFrame) -> DataFrame:
    """Append-only alias moves: every version becomes challenger; approved ones champion."""
    aliases = F.when(F.col("decision") == "APPROVE", F.array(F.lit("challenger"), F.lit("champion"))).otherwise(F.array(F.lit("challenger")))
    return replay.select(*MODEL_KEY, F.explode(aliases).alias("alias"), "version", F.col("start_time").alias("event_ts"), "run_id", "mae")


def alias_state(events: DataFrame) -> DataFrame:
    """W-02: current version per alias = latest event (ties: higher version), with its run and MAE."""
    latest = F.max_by(F.struct("version", "event_ts", "run_id", "mae"), F.struct("event_ts", "version"))
    return events.groupBy(*MODEL_KEY, "alias").agg(latest.alias("_s")).select(*MODEL_KEY, "alias", "_s.*")


def alias_metrics(state: DataFrame, aliases=("challenger", "champion")) -> DataFrame:
    """J-01: per (model, env) of the state and alias its version, run and MAE; a missing alias says "none"."""
    per_model = state.groupBy(*MODEL_KEY).agg(F.map_from_entries(F.collect_list(F.struct(
        "alias", F.struct("version", "run_id", "mae")))).alias("_m"))  # one entry an alias name
    one = per_model.select(*MODEL_KEY, F.explode(F.array(*[F.struct(F.lit(a).alias("alias"), F.try_element_at("_m", F.lit(a)).alias("s"))
                                                           for a in aliases])).alias("_a"))
    return one.select(*MODEL_KEY, "_a.alias", "_a.s.version", "_a.s.run_id", "_a.s.mae",
                      F.when(F.col("_a.s").isNull(), "none").otherwise("found").alias("status"))


def latest_run(runs: DataFrame) -> DataFrame:
    """T-06: most recent run per model (ties: higher run id)."""
    return runs.groupBy("model_name").agg(
        F.max_by("run_id", F.struct("start_time", "run_id")).alias("run_id"),
        F.max("start_time").alias("start_time"))


def latest_version(runs: DataFrame) -> DataFrame:
    """A-11: highest version number per registered model: versions count its runs."""
    return runs.groupBy(*MODEL_KEY).agg(F.count(F.lit(1)).cast("int").alias("latest_version"))


def compare_metrics(df: DataFrame, challenger: str = "mae", champion: str = "champion_mae") -> DataFrame:
    """S-09: delta, percent change (0 when the champion is 0), better (<=) and a summary line."""
    c, p = F.col(challenger), F.col(champion)
    delta = c - p
    pct = F.when(p != 0, delta / p * 100).otherwise(F.lit(0.0))
    better = c <= p
    direction = F.when(
        better,
        F.concat(F.lit("improved by "), fixed_text(F.abs(delta), 4), F.lit(" ("), fixed_text(F.abs(pct), 1), F.lit("%)")),
    ).otherwise(
        F.concat(F.lit("degraded by "), fixed_text(delta, 4), F.lit(" ("), fixed_text(pct, 1),
                 F.lit("%) - BLOCKER unless justified")))
    summary = F.concat(F.lit("Challenger MAE: "), fixed_text(c, 4), F.lit(" vs Champion MAE: "),
                       fixed_text(p, 4), F.lit(" - "), direction)
    return df.withColumn("delta", delta).withColumn("pct_change", pct).withColumn("better", better) \
        .withColumn("summary", summary)


def config_diff(replay: DataFrame) -> DataFrame:
    """J-02: key-level change set between each version's configuration and its champion's.

    ``replay`` carries both maps, so a key on one side only is "added" or "removed" and
    differing values are "changed" within the row: no join. Versions without a champion
    have no changes.
    """
    keys = F.array_union(F.map_keys("champion_params"), F.map_keys("params"))
    rows = replay.where(F.col("champion_params").isNotNull()).select(
        *MODEL_KEY, "version", "params", "champion_params", F.explode(keys).alias("key"))
    old, new = F.try_element_at("champion_params", F.col("key")), F.try_element_at("params", F.col("key"))
    change = F.when(old.isNull(), "added").when(new.isNull(), "removed").when(old != new, "changed")
    return rows.select(*MODEL_KEY, "version", "key", old.alias("old_value"), new.alias("new_value"),
                       change.alias("change")).where(F.col("change").isNotNull())


def config_sync_check(diff: DataFrame) -> DataFrame:
    """J-05: a hyperparameter or the feature list changed while the MAE threshold did not -> ML-01 finding."""
    hp = F.col("key").isin(*HYPERPARAMETERS, FEATURES_KEY)
    agg = diff.groupBy(*MODEL_KEY, "version").agg(
        F.bool_or(hp).alias("hp_changed"),
        F.bool_or(F.col("key") == THRESHOLD_KEY).alias("threshold_changed"))
    return _unsynced(agg)


def _unsynced(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("hp_changed") & ~F.col("threshold_changed")).select(
        *MODEL_KEY, "version", "hp_changed", "threshold_changed",
        F.lit("ML-01").alias("rule_id"), F.lit("BLOCKER").alias("severity"),
        F.lit("Hyperparameters changed without an updated max_acceptable_mae").alias("message"))


def config_sync_of(replay: DataFrame) -> DataFrame:
    """J-05 within the row: ``replay`` carries both configurations, so nothing is exploded or grouped again.

    The keys are compared one by one, as columns: maps would be built anew for every key that is looked up.
    """
    def changed(key: str) -> Column:
        return ~F.col(f"champion_config.{key}").cast("string").eqNullSafe(F.col(key).cast("string"))

    of_model = reduce(or_, [changed(k) for k in (*HYPERPARAMETERS, FEATURES_KEY)])
    rows = replay.where(F.col("champion_config").isNotNull())
    return _unsynced(rows.select(*MODEL_KEY, "version", of_model.alias("hp_changed"), changed(THRESHOLD_KEY).alias("threshold_changed")))


def mae_within_threshold(runs: DataFrame) -> DataFrame:
    """P-07: ``mae <= max_acceptable_mae`` per run."""
    return runs.select("run_id", "mae", THRESHOLD_KEY,
                       (F.col("mae") <= F.col(THRESHOLD_KEY)).alias("mae_within_threshold"))


def config_table(runs: DataFrame) -> DataFrame:
    """Training configs as the config file's shape: hyperparameter map, features, threshold."""
    hp = []
    for k in HYPERPARAMETERS:
        hp += [F.lit(k), F.col(k).cast("string")]
    return runs.select(
        F.col("run_id").alias("config_id"), "model_name",
        F.create_map(*hp).alias("hyperparameters"),
        F.split(FEATURES_KEY, ",").alias("features"),
        F.col(THRESHOLD_KEY).alias(THRESHOLD_KEY),
    )


def config_validity(configs: DataFrame) -> DataFrame:
    """P-08: one row per failed check (missing key, empty features, non-positive values)."""
    checks = [
        F.when(F.col("model_name").isNull() | ~F.col("model_name").rlike(r"\S"), F.lit("missing:model_name")),
        F.when(F.col("hyperparameters").isNull(), F.lit("missing:hyperparameters")),
        F.when(F.col("features").isNull() | (F.size("features") == 0), F.lit("empty:features")),
        F.when(F.col(THRESHOLD_KEY).isNull(), F.lit(f"missing:{THRESHOLD_KEY}"))
        .when(F.col(THRESHOLD_KEY) <= 0, F.lit(f"non_positive:{THRESHOLD_KEY}")),
    ]
    for k in HYPERPARAMETERS:
        v = F.try_element_at(F.col("hyperparameters"), F.lit(k))
        checks.append(F.when(F.col("hyperparameters").isNotNull() & v.isNull(), F.lit(f"missing:{k}"))
                      .when(v.try_cast("double") <= 0, F.lit(f"non_positive:{k}")))
    failed = F.array_compact(F.array(*checks))
    return configs.select("config_id", F.explode(failed).alias("failure")).select(
        "config_id", F.split_part("failure", F.lit(":"), F.lit(1)).alias("check"),
        F.split_part("failure", F.lit(":"), F.lit(2)).alias("field"))


def resolve_version(requests: DataFrame, state: DataFrame, alias: str = "champion") -> DataFrame:
    """P-09: a numeric request pins that version; anything else resolves the alias."""
    # the state has a row per alias: adaptive execution broadcasts it, or splits hot models
    cur = state.where(F.col("alias") == alias).select(*MODEL_KEY, F.col("version").alias("alias_version"))
    pinned = F.col("requested").rlike("^[0-9]+$")
    return requests.join(cur, MODEL_KEY, "left").select(
        "request_id", *MODEL_KEY, "requested",
        F.when(pinned, F.col("requested").try_cast("int")).otherwise(F.col("alias_version")).alias("version"),
        F.when(pinned, "pinned").otherwise("alias").alias("resolved_by"))


def registry_retention(versions: DataFrame, wipe_envs=()) -> DataFrame:
    """A-10: keep the lowest version as champion (drop challenger), delete the rest;
    a wiped env deletes every version and both aliases.
    """
    keep = (versions.where(~F.col("env").isin(*wipe_envs) if wipe_envs else F.lit(True))
            .groupBy(*MODEL_KEY).agg(F.min("version").alias("version")))
    drop = versions.select(*MODEL_KEY, "version").join(
        sized_broadcast(keep), [*MODEL_KEY, "version"], "left_anti")
    return keep.select(*MODEL_KEY, "version", F.lit("keep_as_champion").alias("action")).unionByName(
        drop.select(*MODEL_KEY, "version", F.lit("delete").alias("action")))


def mae_by_run(predictions: DataFrame) -> DataFrame:
    """A-12: mean absolute error per run, exact from cent-valued targets and predictions."""
    from sluice.functions.numeric import round_ratio

    # 38 digits: the sum of a run's errors, scaled for rounding, outgrows a BIGINT
    err_cents = F.abs((F.col("y") - F.col("yhat")) * 100).cast("decimal(20,0)")
    agg = predictions.groupBy("run_id").agg(F.sum(err_cents).cast("decimal(28,0)").alias("_e"), F.count(F.lit(1)).alias("n"))
    return agg.select("run_id", F.col("n").cast("bigint").alias("n"),
                      round_ratio("_e", F.col("n") * 100, 6).alias("mae"))
