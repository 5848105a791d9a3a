"""Windows, splits, features, and metrics on given predictions."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.catalog.common import (
    MONTH,
    PROFILE,
    RUN_MONTH,
    WINDOW,
    YEAR,
    big,
    dollars,
    half_up,
    in_months,
    project,
    sample_gold,
    sample_silver,
    with_tables,
)
from tripmart.config import (
    CLASSIFICATION_FEATURES,
    REGRESSION_FEATURES,
    ZONE_FEATURES,
    ZONE_FREQUENT,
    ZONE_PREMIUM,
    ZONE_STANDARD,
    ZONE_TIP,
    ZoneLabel,
)
from tripmart.functions.exact import ratio_half_up
from tripmart.operators import features, metrics, models, windows

TRIP_COLUMNS = ("trip_key", "tpep_pickup_datetime", "PULocationID")
# Thresholds in the range of the sample data, so that every label occurs.
SAMPLE_LABELS = (
    ZoneLabel(ZONE_PREMIUM, {"avg_revenue": (38.5, None), "avg_distance": (6, None)}),
    ZoneLabel(ZONE_FREQUENT, {"total_trips": (1880, None), "avg_distance": (None, 6.3)}),
    ZoneLabel(ZONE_TIP, {"avg_tip_efficiency": (5.5, None)}),
    ZoneLabel(ZONE_STANDARD, {}),
)


def train_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.training_window(sample_silver(spark, sf_dir), RUN_MONTH, WINDOW).select(*TRIP_COLUMNS)


def predict_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.prediction_window(sample_silver(spark, sf_dir), RUN_MONTH).select(*TRIP_COLUMNS)


def gold_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.mart_window(sample_gold(spark, sf_dir), RUN_MONTH, WINDOW).select(
        "pickup_date", "PULocationID", "total_trips"
    )


def key_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = sample_silver(spark, sf_dir)
    return windows.key_sample(silver, F.col("trip_key"), 10).select(*TRIP_COLUMNS)


def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = windows.holdout_split(sample_silver(spark, sf_dir), F.col("trip_key"))
    return (
        train.select(F.lit("train").alias("side"), *TRIP_COLUMNS)
        .unionByName(test.select(F.lit("test").alias("side"), *TRIP_COLUMNS))
    )


def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = sample_silver(spark, sf_dir)
    return silver.select("trip_key", "tpep_pickup_datetime", *[
        c.alias(n) for n, c in features.pickup_parts("tpep_pickup_datetime").items()
    ])


def reg_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.fare_features(sample_silver(spark, sf_dir), keep=("trip_key",))


def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted scaler on all rows; vector elements to six decimals."""
    frame = features.fare_features(sample_silver(spark, sf_dir), keep=("trip_key",))
    stages = features.scaled_stages(REGRESSION_FEATURES, centred=False)
    scaled = Pipeline(stages=stages).fit(frame).transform(frame)
    flat = features.vector_columns(scaled, "features", REGRESSION_FEATURES, "scaled_")
    return flat.select("trip_key", *[F.round(f"scaled_{n}", 6).alias(f"scaled_{n}") for n in REGRESSION_FEATURES])


def tip_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = sample_silver(spark, sf_dir)
    label = features.tip_label(F.col("tip_amount"), F.col("fare_amount"))
    return project(silver.withColumn("tip_label", label), "trip_key", "tip_amount", "fare_amount", "tip_label")


def cls_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.tip_features(sample_silver(spark, sf_dir), keep=("trip_key",))


def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = features.tip_features(sample_silver(spark, sf_dir))
    model = Pipeline(stages=features.tip_stages(CLASSIFICATION_FEATURES)).fit(frame)
    return features.label_table(model, frame)


def zone_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.zone_profile(sample_gold(spark, sf_dir))


def zone_profile_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = features.zone_profile(sample_gold(spark, sf_dir))
    model = Pipeline(stages=features.scaled_stages(ZONE_FEATURES, centred=True)).fit(profile)
    flat = features.vector_columns(model.transform(profile), "features", ZONE_FEATURES, "z_")
    return flat.select("PULocationID", *[F.round(f"z_{n}", 6).alias(f"z_{n}") for n in ZONE_FEATURES])


def daily_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.daily_demand(sample_gold(spark, sf_dir))


def daily_demand_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.daily_demand(sample_gold(spark, sf_dir), ("PULocationID",))


# -- metrics on predictions made by a formula -------------------------------


def given_fares(silver: DataFrame) -> DataFrame:
    """Predicted total = fare + 5."""
    return silver.select(
        *TRIP_COLUMNS,
        F.col("total_amount").cast("double").alias("total_amount"),
        (F.col("fare_amount") + 5).cast("double").alias("predicted_total_amount"),
    )


def given_tips(silver: DataFrame) -> DataFrame:
    """Predicted class from payment type and rate code."""
    guess = (
        F.when(F.col("payment_type") != 1, "Baja")
        .when(F.col("RatecodeID") <= 2, "Alta")
        .otherwise("Media")
    )
    label = features.tip_label(F.col("tip_amount"), F.col("fare_amount"))
    return silver.select(*TRIP_COLUMNS, label.alias("tip_label"), guess.alias("predicted_tip_label"))


def given_clusters(gold: DataFrame) -> DataFrame:
    """Cluster = zone number modulo 4."""
    return features.zone_profile(gold).withColumn("cluster", F.col("PULocationID") % 4)


def rmse_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = given_fares(sample_silver(spark, sf_dir))
    score = metrics.rmse(table, F.col("total_amount"), F.col("predicted_total_amount"))
    return score.select(F.round("rmse", 6).alias("rmse"))


def confusion_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(given_tips(sample_silver(spark, sf_dir)), "tip_label", "predicted_tip_label")


def f1_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = metrics.classification_scores(confusion_given(spark, sf_dir))
    return scores.select(*[F.round(c, 9).alias(c) for c in scores.columns])


def metric_table_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        metrics.metric_rows(rmse_given(spark, sf_dir), "fare_regression", YEAR, MONTH),
        metrics.metric_rows(f1_given(spark, sf_dir), "tip_classification", YEAR, MONTH),
    ]
    return metrics.metric_table(parts)


def cluster_labels_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.label_zones(given_clusters(sample_gold(spark, sf_dir)), SAMPLE_LABELS)


QUERIES = {
    "train_window": train_window,
    "predict_window": predict_window,
    "gold_window": gold_window,
    "key_sample": key_sample,
    "holdout_split": holdout_split,
    "calendar_parts": calendar_parts,
    "reg_features": reg_features,
    "scaled_features": scaled_features,
    "tip_labels": tip_labels,
    "cls_features": cls_features,
    "label_index": label_index,
    "zone_profile": zone_profile,
    "zone_profile_scaled": zone_profile_scaled,
    "daily_demand": daily_demand,
    "daily_demand_zones": daily_demand_zones,
    "rmse_given": rmse_given,
    "confusion_given": confusion_given,
    "f1_given": f1_given,
    "metric_table_given": metric_table_given,
    "cluster_labels_given": cluster_labels_given,
}

_TRIP = ", ".join(TRIP_COLUMNS)
_HOUR = "CAST(hour(tpep_pickup_datetime) AS INT)"
_DOW = "CAST(dayofweek(tpep_pickup_datetime) + 1 AS INT)"
LABEL_SQL = (
    "CASE WHEN tip_c * 100 > fare_c * 20 THEN 'Alta'"
    " WHEN tip_c * 100 >= fare_c * 5 THEN 'Media' ELSE 'Baja' END"
)
GUESS_SQL = (
    "CASE WHEN payment_type <> 1 THEN 'Baja' WHEN RatecodeID <= 2 THEN 'Alta' ELSE 'Media' END"
)

_FEATURE_SQL = {
    "trip_distance": "trip_distance",
    "trip_duration_minutes": "seconds / 60.0",
    "passenger_count": "CAST(passenger_count AS DOUBLE)",
    "PULocationID": "CAST(PULocationID AS DOUBLE)",
    "DOLocationID": "CAST(DOLocationID AS DOUBLE)",
    "pickup_hour": f"CAST({_HOUR} AS DOUBLE)",
    "pickup_day_of_week": f"CAST({_DOW} AS DOUBLE)",
    "payment_type": "CAST(payment_type AS DOUBLE)",
    "RatecodeID": "CAST(RatecodeID AS DOUBLE)",
}


def _features(names: tuple[str, ...]) -> str:
    return ", ".join(f"{_FEATURE_SQL[n]} AS {n}" for n in names)


_REG = f"""reg AS (SELECT trip_key, tpep_pickup_datetime, {_features(REGRESSION_FEATURES)},
 {dollars("total_c")} AS total_amount FROM silver WHERE passenger_count IS NOT NULL)"""

PROFILE_SQL = PROFILE.format(source="gold")

CLUSTERS_SQL = f"""{PROFILE_SQL},
clusters AS (SELECT *, CAST(PULocationID % 4 AS INT) AS cluster FROM profile),
labels AS (SELECT cluster, CASE
  WHEN AVG(avg_revenue) > 38.5 AND AVG(avg_distance) > 6 THEN 'Premium Zone'
  WHEN AVG(total_trips) > 1880 AND AVG(avg_distance) < 6.3 THEN 'High Frequency Zone'
  WHEN AVG(avg_tip_efficiency) > 5.5 THEN 'High Tip Zone'
  ELSE 'Standard Zone' END AS cluster_label FROM clusters GROUP BY cluster)"""

SCORES_SQL = f"""cells AS (SELECT {LABEL_SQL} AS a, {GUESS_SQL} AS p, COUNT(*) AS n FROM silver GROUP BY ALL),
classes AS (SELECT c, SUM(n) FILTER (WHERE a = c) AS support, COALESCE(SUM(n) FILTER (WHERE p = c), 0) AS predicted,
  COALESCE(SUM(n) FILTER (WHERE a = c AND p = c), 0) AS hits
  FROM cells, (SELECT DISTINCT a AS c FROM cells) GROUP BY c),
scores AS (SELECT ROUND(CAST(SUM(hits) AS DOUBLE) / SUM(support), 9) AS accuracy,
  ROUND(SUM(2.0::DOUBLE * hits / (support + predicted) * support) / SUM(support), 9) AS weighted_f1 FROM classes)"""

RMSE_SQL = """ROUND(sqrt(CAST(SUM((total_c - fare_c - 500) * (total_c - fare_c - 500)) AS DOUBLE) / COUNT(*)) / 100, 6)"""

ORACLE = {
    "train_window": with_tables(
        "silver",
        f"SELECT {_TRIP} FROM silver WHERE {in_months('tpep_pickup_datetime', RUN_MONTH.before(WINDOW))}",
    ),
    "predict_window": with_tables(
        "silver", f"SELECT {_TRIP} FROM silver WHERE {in_months('tpep_pickup_datetime', RUN_MONTH)}"
    ),
    "gold_window": with_tables(
        "gold",
        f"""SELECT pickup_date, PULocationID, total_trips FROM gold
 WHERE {in_months("pickup_date", RUN_MONTH.widened(WINDOW))}""",
    ),
    "key_sample": with_tables("silver", f"SELECT {_TRIP} FROM silver WHERE trip_key < 10"),
    "holdout_split": with_tables(
        "silver",
        f"SELECT CASE WHEN trip_key < 80 THEN 'train' ELSE 'test' END AS side, {_TRIP} FROM silver",
    ),
    "calendar_parts": with_tables(
        "silver",
        f"""SELECT trip_key, tpep_pickup_datetime, {_HOUR} AS pickup_hour,
 {_DOW} AS pickup_day_of_week FROM silver""",
    ),
    "reg_features": with_tables("silver", "SELECT * FROM reg", _REG),
    "scaled_features": with_tables(
        "silver",
        "SELECT trip_key, "
        + ", ".join(
            f"ROUND({n} / STDDEV_SAMP({n}) OVER (), 6) AS scaled_{n}" for n in REGRESSION_FEATURES
        )
        + " FROM reg",
        _REG,
    ),
    "tip_labels": with_tables(
        "silver",
        f"""SELECT trip_key, {dollars("tip_c")} AS tip_amount, {dollars("fare_c")} AS fare_amount,
 {LABEL_SQL} AS tip_label FROM silver""",
    ),
    "cls_features": with_tables(
        "silver",
        f"""SELECT trip_key, tpep_pickup_datetime, {LABEL_SQL} AS tip_label,
 {_features(CLASSIFICATION_FEATURES)}, {dollars("fare_c")} AS fare_amount
 FROM silver WHERE passenger_count IS NOT NULL""",
    ),
    "label_index": with_tables(
        "silver",
        f"""SELECT tip_label, {big("n")} AS row_count,
 CAST(ROW_NUMBER() OVER (ORDER BY n DESC, tip_label) - 1 AS DOUBLE) AS label
 FROM (SELECT {LABEL_SQL} AS tip_label, COUNT(*) AS n FROM silver
  WHERE passenger_count IS NOT NULL GROUP BY ALL)""",
    ),
    "zone_profile": with_tables("gold", "SELECT * FROM profile", PROFILE_SQL),
    "zone_profile_scaled": with_tables(
        "gold",
        "SELECT PULocationID, "
        + ", ".join(
            f"ROUND(({n} - AVG({n}) OVER ()) / STDDEV_SAMP({n}) OVER (), 6) AS z_{n}"
            for n in ZONE_FEATURES
        )
        + " FROM profile",
        PROFILE_SQL,
    ),
    "daily_demand": with_tables(
        "gold",
        f"SELECT pickup_date AS ds, {big('SUM(total_trips)')} AS y FROM gold GROUP BY pickup_date",
    ),
    "daily_demand_zones": with_tables(
        "gold", "SELECT PULocationID, pickup_date AS ds, total_trips AS y FROM gold"
    ),
    "rmse_given": with_tables("silver", f"SELECT {RMSE_SQL} AS rmse FROM silver"),
    "confusion_given": with_tables(
        "silver",
        f"""SELECT {LABEL_SQL} AS actual, {GUESS_SQL} AS predicted, {big("COUNT(*)")} AS row_count
 FROM silver GROUP BY ALL""",
    ),
    "f1_given": with_tables("silver", "SELECT * FROM scores", SCORES_SQL),
    "metric_table_given": with_tables(
        "silver",
        f"""SELECT 1998 AS run_year, 3 AS run_month, * FROM (
 SELECT 'fare_regression' AS model, 'rmse' AS metric, {RMSE_SQL} AS value FROM silver
 UNION ALL SELECT 'tip_classification', 'accuracy', accuracy FROM scores
 UNION ALL SELECT 'tip_classification', 'weighted_f1', weighted_f1 FROM scores)""",
        SCORES_SQL,
    ),
    "cluster_labels_given": with_tables(
        "gold", "SELECT c.*, l.cluster_label FROM clusters c JOIN labels l USING (cluster)", CLUSTERS_SQL
    ),
}
