"""Fitted models.  Their values depend on the trainer, so they have no check
SQL; tests assert their properties."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.catalog.common import (
    MONTH,
    RUN_MONTH,
    WINDOW,
    YEAR,
    sample_gold,
    sample_lake,
    sample_silver,
)
from tripmart.config import ModelConfig
from tripmart.operators import features, metrics, models, windows
from tripmart.session import materialise
from tripmart.sources.lake import Lake, overwrite_partitions, read_table

CFG = ModelConfig()


def _stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned trips of the whole history, stored and read back."""
    lake: Lake = sample_lake(spark)
    overwrite_partitions(sample_silver(spark, sf_dir), lake.silver, rebalance=True)
    return read_table(spark, lake.silver)


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(features.zone_profile(sample_gold(spark, sf_dir)), "zone_profile")


def rf_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the run month predicted by a forest of the months before."""
    silver = _stored_silver(spark, sf_dir)
    past = windows.training_window(silver, RUN_MONTH, WINDOW)
    train, _ = windows.holdout_split(
        features.fare_features(past, CFG, ("trip_key",)), F.col("trip_key"), CFG.train_percent
    )
    now = features.fare_features(windows.prediction_window(silver, RUN_MONTH), CFG)
    return models.predict_fares(models.fit_fares(train, CFG), now)


def rf_regression_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    past = windows.training_window(_stored_silver(spark, sf_dir), RUN_MONTH, WINDOW)
    train, test = windows.holdout_split(
        features.fare_features(past, CFG, ("trip_key",)), F.col("trip_key"), CFG.train_percent
    )
    scored = models.predict_fares(models.fit_fares(train, CFG), test)
    score = metrics.rmse(scored, F.col("total_amount"), F.col("predicted_total_amount"))
    return metrics.metric_rows(score, "fare_regression", YEAR, MONTH)


def rf_tip_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _stored_silver(spark, sf_dir)
    past = windows.training_window(silver, RUN_MONTH, WINDOW)
    train, _ = windows.holdout_split(
        features.tip_features(past, CFG, ("trip_key",)), F.col("trip_key"), CFG.train_percent
    )
    now = features.tip_features(windows.prediction_window(silver, RUN_MONTH), CFG)
    return models.predict_tips(models.fit_tips(train, CFG), now)


def rf_tip_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    past = windows.training_window(_stored_silver(spark, sf_dir), RUN_MONTH, WINDOW)
    train, test = windows.holdout_split(
        features.tip_features(past, CFG, ("trip_key",)), F.col("trip_key"), CFG.train_percent
    )
    scored = models.predict_tips(models.fit_tips(train, CFG), test)
    scores = metrics.classification_scores(metrics.confusion(scored, "label", "prediction"))
    return metrics.metric_rows(scores, "tip_classification", YEAR, MONTH)


def kmeans_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = _profile(spark, sf_dir)
    model = models.fit_zones(profile, CFG)
    return models.label_zones(models.assign_zones(model, profile, CFG), CFG.zone_labels)


def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = _profile(spark, sf_dir)
    value = models.silhouette(models.fit_zones(profile, CFG), profile)
    return metrics.metric_rows(
        profile.groupBy().agg(F.lit(value).alias("silhouette")), "zone_clusters", YEAR, MONTH
    )


QUERIES = {
    "rf_regression": rf_regression,
    "rf_regression_rmse": rf_regression_rmse,
    "rf_tip_class": rf_tip_class,
    "rf_tip_scores": rf_tip_scores,
    "kmeans_zones": kmeans_zones,
    "silhouette": silhouette,
}

ORACLE: dict[str, str] = {}
