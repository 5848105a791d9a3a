"""Monthly training, prediction and forecast on the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import ForecastConfig, ModelConfig, Run
from tripmart.functions.keys import bucket
from tripmart.operators import features, forecast, metrics, models, windows
from tripmart.session import prepare
from tripmart.sources.lake import Lake, in_run, overwrite_run, read_table


def training_trips(silver: DataFrame, run: Run, cfg: ModelConfig) -> DataFrame:
    """All trips of the training window with their split key."""
    past = windows.training_window(silver, run.months, cfg.window_months)
    return past.withColumn("split_key", bucket(cfg.split_columns))


def fares(spark: SparkSession, lake: Lake, run: Run, cfg: ModelConfig) -> DataFrame:
    """Train on the window before the run month, predict the run month.

    All frames are narrow transformations of the stored table, so a lost task
    is recomputed from files; the forest keeps its own binned copy for its
    passes.  Returns the hold-out metrics.
    """
    silver = read_table(spark, lake.silver)
    rows = features.fare_features(training_trips(silver, run, cfg), cfg, ("split_key",))
    train, test = windows.holdout_split(rows, F.col("split_key"), cfg.train_percent)
    model = models.fit_fares(train, cfg)
    score = metrics.rmse(
        models.predict_fares(model, test), F.col("total_amount"), F.col("predicted_total_amount")
    )
    now = features.fare_features(windows.prediction_window(silver, run.months), cfg)
    overwrite_run(models.predict_fares(model, now), lake.fare_predictions, run.year, run.month)
    return metrics.metric_rows(score, "fare_regression", run.year, run.month)


def tips(spark: SparkSession, lake: Lake, run: Run, cfg: ModelConfig) -> DataFrame:
    silver = read_table(spark, lake.silver)
    trips = training_trips(silver, run, cfg).withColumn(
        "sample_key", bucket(cfg.split_columns, purpose="sample")
    )
    rows = features.tip_features(trips, cfg, ("split_key", "sample_key"))
    train, test = windows.holdout_split(rows, F.col("split_key"), cfg.train_percent)
    if cfg.sample_percent < 100:
        train = windows.key_sample(train, F.col("sample_key"), cfg.sample_percent)
    model = models.fit_tips(train, cfg)
    matrix = metrics.confusion(models.predict_tips(model, test), "label", "prediction")
    now = features.tip_features(windows.prediction_window(silver, run.months), cfg)
    overwrite_run(models.predict_tips(model, now), lake.tip_predictions, run.year, run.month)
    return metrics.metric_rows(
        metrics.classification_scores(matrix), "tip_classification", run.year, run.month
    )


def zones(spark: SparkSession, lake: Lake, run: Run, cfg: ModelConfig) -> DataFrame:
    """Cluster the zones.  Their profiles (one row per zone) are stored first,
    so the iterations read them and not the mart."""
    gold = windows.mart_window(read_table(spark, lake.gold), run.months, cfg.window_months)
    overwrite_run(
        features.zone_profile(gold), lake.zone_profiles, run.year, run.month, rebalance=True
    )
    profile = in_run(read_table(spark, lake.zone_profiles), run.year, run.month)
    model = models.fit_zones(profile, cfg)
    labelled = models.label_zones(models.assign_zones(model, profile, cfg), cfg.zone_labels)
    overwrite_run(labelled, lake.clusters, run.year, run.month, rebalance=True)
    score = spark.range(1).select(F.lit(float(models.silhouette(model, profile))).alias("silhouette"))
    return metrics.metric_rows(score, "zone_clusters", run.year, run.month)


def demand(
    spark: SparkSession, lake: Lake, run: Run, cfg: ModelConfig, shape: ForecastConfig
) -> DataFrame:
    """City and zone forecasts from the mart up to the end of the run month."""
    gold = windows.mart_until(read_table(spark, lake.gold), run.months)
    city = features.daily_demand(gold)
    history = forecast.history_of(city)
    model = forecast.fit_city(city, history, shape)
    overwrite_run(
        forecast.forecast_city(model, city, history, cfg.horizon_days, shape),
        lake.forecasts,
        run.year,
        run.month,
        rebalance=True,
    )
    keys = ["PULocationID"]
    by_zone = features.daily_demand(gold, tuple(keys))
    fitted = forecast.fit_many(by_zone, keys, history, shape)
    overwrite_run(
        forecast.forecast_many(fitted, keys, history, cfg.horizon_days, shape),
        lake.zone_forecasts,
        run.year,
        run.month,
        rebalance=True,
    )
    rmse = float(model.first().sigma)
    score = spark.range(1).select(F.lit(rmse).alias("fit_rmse"))
    return metrics.metric_rows(score, "city_forecast", run.year, run.month)


def run_models(
    spark: SparkSession,
    lake: Lake,
    run: Run,
    cfg: ModelConfig = ModelConfig(),
    shape: ForecastConfig = ForecastConfig(),
) -> None:
    """All four models of a month; each replaces its own run partition, and
    their metrics are stored together."""
    prepare(spark)
    parts = [
        fares(spark, lake, run, cfg),
        tips(spark, lake, run, cfg),
        zones(spark, lake, run, cfg),
        demand(spark, lake, run, cfg, shape),
    ]
    table = metrics.metric_table(parts).drop("run_year", "run_month").coalesce(1)
    overwrite_run(table, lake.metrics, run.year, run.month)
