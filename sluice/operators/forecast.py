"""Demand-forecast features, holdout split, forest training and evaluation on Spark.

Daily demand per (store, category, day) comes from real sales. Calendar lags (sales
7 and 14 days earlier, 0 when that day had none) are built without a window or a
self-join: every daily row also emits its contribution to day+7 and day+14, and one
partially-aggregated group-by on (store, category, day) assembles each row's lags.
The split hashes the row key, so it does not move when data is repartitioned.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.numeric import round_ratio
from sluice.operators import histogram_forest as HF
from sluice.operators.seed import unit_draw

# The demand model's categories, stores and base-demand coefficients.
N_CATEGORIES = 5
N_STORES = 20
BASE_LEVEL = 20.0
EARLY_WEEK_LIFT = 5.0
SEASON_AMPLITUDE = 3.0
STORE_EFFECT = 0.3
PRICE_ELASTICITY = -0.4
PROMO_LIFT = 4.0
CATEGORY_EFFECT = 2.0
PRICE_SCALE = 100.0  # retail prices in the sales data are scaled into the model's 1-50 band
PROMO_DISCOUNT = 0.05
EPOCH = "1992-01-01"
#: Training partitions at least; a cluster has as many as its shuffles.
TRAIN_PARTITIONS = 64

ALL_FEATURES = ["day_of_week", "week_of_year", "store_id", "product_category", "price", "promotion_flag",
                "lag_7d_sales", "lag_14d_sales"]


@dataclass(frozen=True)
class ForecastConfig:
    model_name: str = "demand_forecaster"
    n_estimators: int = 100
    max_depth: int = 8
    min_samples_leaf: int = 5
    random_state: int = 42
    features: list[str] = field(default_factory=lambda: list(ALL_FEATURES))
    max_acceptable_mae: float = 12.0


DEGRADED_CONFIG = ForecastConfig(n_estimators=5, features=["day_of_week", "store_id"], max_acceptable_mae=50.0)


# bins of the features that are not small whole numbers
BIN_WIDTHS = {"price": 0.5, "lag_7d_sales": 8.0, "lag_14d_sales": 8.0}
EXACT_CONFIG = HF.ForestConfig(tuple(ALL_FEATURES), n_trees=5, max_depth=4, widths=BIN_WIDTHS)
EXACT_DEGRADED_CONFIG = HF.ForestConfig(("day_of_week", "store_id"), n_trees=2, max_depth=4, max_acceptable_mae=50.0)


def daily_demand(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Units sold per (store, category, day) with the day's price and promotion flag."""
    parts = part.select("p_partkey", (F.col("p_size") % N_CATEGORIES).cast("int").alias("product_category"),
                        F.col("p_retailprice").cast("decimal(18,2)").alias("_price"))
    j = lineitem.select("l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_shipdate").join(
        parts, F.col("l_partkey") == F.col("p_partkey"))
    day = F.col("l_shipdate").cast("date")
    return j.groupBy((F.col("l_suppkey") % N_STORES).cast("int").alias("store_id"), "product_category",
                     day.alias("day")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("units"),
        F.min("_price").alias("min_price"),
        F.max(F.col("l_discount")).alias("max_discount"),
    ).select("store_id", "product_category", "day",
             F.datediff("day", F.lit(EPOCH).cast("date")).alias("day_number"),
             F.col("units").cast("double").alias("sales"),
             (F.col("min_price").cast("double") / PRICE_SCALE).alias("price"),
             (F.col("max_discount") >= PROMO_DISCOUNT).cast("int").alias("promotion_flag"))


def add_calendar_lags(daily: DataFrame, lags=(7, 14), key=("store_id", "product_category")) -> DataFrame:
    """W-07: ``lag_{n}d_sales`` = sales exactly n calendar days earlier, 0 for a day without sales."""
    names = [f"lag_{n}d_sales" for n in lags]
    row = F.struct(*[c for c in daily.columns if c not in (*key, "day_number")])
    none = F.lit(None).cast("double")

    def part(day: Column, held: Column, lag: int | None) -> Column:
        return F.struct(day.alias("day_number"), held.alias("_row"), *[(F.col("sales") if n == lag else none).alias(m) for n, m in zip(lags, names, strict=True)])

    # a day's row, and what it is to the days that look back on it; the days themselves are computed once
    parts = [part(F.col("day_number"), row, None), *[part(F.col("day_number") + n, F.when(F.lit(False), row), n) for n in lags]]
    merged = daily.select(*key, F.explode(F.array(*parts)).alias("_p")).select(*key, "_p.*").groupBy(*key, "day_number").agg(
        F.max("_row").alias("_row"), *[F.max(n).alias(n) for n in names])
    return merged.where(F.col("_row").isNotNull()).select(
        *key, "day_number", "_row.*", *[F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n in names])


def calendar_features(df: DataFrame) -> DataFrame:
    """S-08: day of week (Monday = 0) and ISO week of year."""
    return df.withColumn("day_of_week", F.weekday("day")).withColumn("week_of_year", F.weekofyear("day"))


def base_demand(df: DataFrame) -> Column:
    """S-08: the demand model's base level from calendar, store, price, promotion and category, clipped at 0."""
    b = (F.lit(BASE_LEVEL) + F.lit(EARLY_WEEK_LIFT) * (F.col("day_of_week") < 2).cast("double")
         + F.lit(SEASON_AMPLITUDE) * F.sin(F.lit(2 * math.pi) * F.col("week_of_year") / F.lit(52.0))
         + F.col("store_id") * F.lit(STORE_EFFECT) + F.lit(PRICE_ELASTICITY) * F.col("price")
         + F.lit(PROMO_LIFT) * F.col("promotion_flag") + F.lit(CATEGORY_EFFECT) * F.col("product_category"))
    return F.greatest(b, F.lit(0.0))


def demand_features(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    return calendar_features(add_calendar_lags(daily_demand(lineitem, part)))


def row_key(df: DataFrame) -> Column:
    return (F.col("store_id").cast("bigint") * 1000003 + F.col("product_category") * 100003 + F.col("day_number"))


def holdout_split(df: DataFrame, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """ML-A: ``split`` = test / train from a hash of the row key (stable under repartitioning)."""
    return df.withColumn("split", F.when(unit_draw(row_key(df), seed) < test_share, "test").otherwise("train"))


def fit_forest(train: DataFrame, cfg: ForecastConfig, label: str = "sales"):
    """ML-B: distributed random forest with the config's hyperparameters (all features per split)."""
    assembler = VectorAssembler(inputCols=list(cfg.features), outputCol="features")
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=cfg.n_estimators,
                               maxDepth=cfg.max_depth, minInstancesPerNode=cfg.min_samples_leaf,
                               seed=cfg.random_state, featureSubsetStrategy="all", maxBins=64)
    return Pipeline(stages=[assembler, rf]).fit(train)


def evaluate(model, test: DataFrame, cfg: ForecastConfig, label: str = "sales") -> DataFrame:
    """ML-C: MAE on the holdout (exact to 1e-6 from 1e-6 units) and the threshold flag."""
    pred = model.transform(test)
    err = F.abs(F.col(label) - F.col("prediction"))
    agg = pred.agg(F.sum(F.round(err * 1e6).cast("bigint")).alias("_e"), F.count(F.lit(1)).alias("n_test"))
    return agg.select(
        F.lit(cfg.model_name).alias("model_name"), F.lit(cfg.n_estimators).alias("n_estimators"),
        F.lit(len(cfg.features)).alias("n_features"), "n_test",
        round_ratio("_e", F.col("n_test") * 1000000, 4).alias("mae"),
        F.lit(cfg.max_acceptable_mae).alias("max_acceptable_mae"),
    ).withColumn("mae_within_threshold", F.col("mae") <= F.col("max_acceptable_mae"))


def mean_predictor(split: DataFrame, label: str = "sales") -> DataFrame:
    """(n_train, n_test, mean_mae): the MAE of predicting the training mean, exact for whole-numbered labels.

    Errors are summed as ``|y * n_train - sum_train|`` in decimals, so no order of rows matters.
    """
    y, train = F.col(label).cast("decimal(20,0)"), F.col("split") == "train"
    facts = split.agg(F.struct(F.count_if(train).alias("n"), F.sum(F.when(train, y)).alias("s"))).scalar()
    test = split.where(~train).select(y.alias("y"), facts.alias("f"))
    off = F.abs(F.col("y") * F.col("f.n") - F.col("f.s")).cast("decimal(38,0)")
    agg = test.agg(F.first("f").alias("f"), F.sum(off).alias("e"), F.count(F.lit(1)).alias("n_test"))
    return agg.select(F.col("f.n").alias("n_train"), "n_test", round_ratio("e", F.col("f.n") * F.col("n_test"), 4).alias("mean_mae"))


def train_and_evaluate(features: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """ML-B + ML-C: the holdout's MAE beside that of the mean predictor."""
    split = holdout_split(features, seed=cfg.random_state)
    # a fixed partitioning and row order make the seeded bootstrap repeatable
    parts = max(TRAIN_PARTITIONS, int(features.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    train = (split.where(F.col("split") == "train").repartition(parts, "store_id", "product_category")
             .sortWithinPartitions("store_id", "product_category", "day_number"))
    model = fit_forest(train, cfg)
    measured = evaluate(model, split.where(F.col("split") == "test"), cfg)
    facts = mean_predictor(split).select(F.struct("n_train", "mean_mae")).scalar()
    return measured.withColumn("_f", facts).select("*", "_f.n_train", "_f.mean_mae").drop("_f").withColumn("beats_mean", F.col("mae") < F.col("mean_mae"))


def exact_predictions(features: DataFrame, cfg: HF.ForestConfig) -> DataFrame:
    """ML-B + ML-C: (k, y, prediction_e6) of the holdout by a forest whose every number can be recomputed."""
    split = holdout_split(features, seed=cfg.seed)
    _, predicted = HF.fit_and_predict(split, cfg, row_key(split))
    return predicted.select("k", "y", "prediction_e6")


def train_and_evaluate_exact(features: DataFrame, cfg: HF.ForestConfig) -> DataFrame:
    """ML-B + ML-C: MAE, threshold flag and the mean predictor's MAE of the recomputable forest."""
    measured = HF.mean_error(exact_predictions(features, cfg))
    facts = mean_predictor(holdout_split(features, seed=cfg.seed)).select(F.struct("n_train", "mean_mae")).scalar()
    return measured.withColumn("_f", facts).select(
        F.lit(cfg.n_trees).alias("n_estimators"), F.lit(len(cfg.features)).alias("n_features"), "_f.n_train", "n_test", "mae", "_f.mean_mae",
        (F.col("mae") < F.col("_f.mean_mae")).alias("beats_mean"), (F.col("mae") <= F.lit(cfg.max_acceptable_mae)).alias("mae_within_threshold"))
