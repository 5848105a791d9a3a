"""Feature frames of the models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.config import (
    TIP_HIGH,
    TIP_HIGH_ABOVE,
    TIP_LOW,
    TIP_MEDIUM,
    TIP_MEDIUM_FROM,
    ModelConfig,
)
from tripmart.functions.calendar import pickup_parts
from tripmart.functions.exact import units

PICKUP = "tpep_pickup_datetime"


def tip_label(tip: Column, fare: Column) -> Column:
    """Tip class by share of the fare, compared without division.

    ``tip`` and ``fare`` are decimals, so a tip of exactly 20 or 5 percent
    always lands in the middle class.  A null share falls to the low class.
    """
    percent = tip * 100
    return (
        F.when(percent > fare * TIP_HIGH_ABOVE, TIP_HIGH)
        .when(percent >= fare * TIP_MEDIUM_FROM, TIP_MEDIUM)
        .otherwise(TIP_LOW)
    )


def _keep(silver: DataFrame, keep: tuple[str, ...]) -> list[Column]:
    return [F.col(c) for c in keep if c in silver.columns]


def fare_features(
    silver: DataFrame, cfg: ModelConfig = ModelConfig(), keep: tuple[str, ...] = ()
) -> DataFrame:
    """Numeric inputs and label of the fare model; rows with a null drop out.

    The output has the pickup time, ``keep`` and, as doubles, the features and
    ``total_amount``.
    """
    names = cfg.regression_features
    wide = silver.withColumns(pickup_parts(PICKUP))
    numbers = [F.col(c).cast("double").alias(c) for c in (*names, "total_amount")]
    return wide.select(PICKUP, *_keep(silver, keep), *numbers).dropna(
        subset=[*names, "total_amount"]
    )


def tip_features(
    silver: DataFrame, cfg: ModelConfig = ModelConfig(), keep: tuple[str, ...] = ()
) -> DataFrame:
    """Numeric inputs and label of the tip model.

    Rows without distance or fare have no meaningful label; rows with any
    other null would be skipped when the vector is assembled, so they are
    dropped here, before the label index is counted.
    """
    names = cfg.classification_features
    wide = silver.withColumns(
        pickup_parts(PICKUP) | {"tip_label": tip_label(F.col("tip_amount"), F.col("fare_amount"))}
    )
    numbers = [F.col(c).cast("double").alias(c) for c in (*names, "fare_amount")]
    return wide.select(PICKUP, *_keep(silver, keep), "tip_label", *numbers).dropna(
        subset=["tip_label", "fare_amount", *names]
    )


def zone_profile(gold: DataFrame) -> DataFrame:
    """One row per zone: unweighted mean of its days, sum of its trips.

    Daily metrics have two decimals, so they are summed as whole hundredths
    and divided once.
    """

    def mean(column: str) -> Column:
        return F.sum(units(F.col(column))).cast("double") / (F.count(column) * 100)

    def mean_or_null(column: str) -> Column:
        return F.when(F.count(column) > 0, mean(column))

    return (
        gold.groupBy("PULocationID")
        .agg(
            mean_or_null("avg_revenue").alias("avg_revenue"),
            mean_or_null("avg_distance").alias("avg_distance"),
            mean_or_null("avg_duration_minutes").alias("avg_duration_minutes"),
            mean_or_null("tip_efficiency_pct").alias("avg_tip_efficiency"),
            F.sum("total_trips").cast("double").alias("total_trips"),
        )
        .dropna()
    )


def daily_demand(gold: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Trips per day as ``ds, y``, for the city or per key."""
    return (
        gold.groupBy(*by, F.col("pickup_date").alias("ds"))
        .agg(F.sum("total_trips").alias("y"))
    )


# -- MLlib stages -----------------------------------------------------------


def assembler(names: tuple[str, ...], output: str) -> VectorAssembler:
    return VectorAssembler(inputCols=list(names), outputCol=output, handleInvalid="skip")


def scaled_stages(names: tuple[str, ...], centred: bool) -> list:
    """Assemble, then divide by the sample deviation (after centring)."""
    scaler = StandardScaler(
        inputCol="features_raw", outputCol="features", withMean=centred, withStd=True
    )
    return [assembler(names, "features_raw"), scaler]


def tip_stages(names: tuple[str, ...]) -> list:
    """Index labels by falling frequency, assemble."""
    indexer = StringIndexer(
        inputCol="tip_label",
        outputCol="label",
        handleInvalid="skip",
        stringOrderType="frequencyDesc",
    )
    return [indexer, assembler(names, "features")]


def vector_columns(df: DataFrame, column: str, names: tuple[str, ...], prefix: str) -> DataFrame:
    """Vector elements as plain columns, for reports and checks."""
    parts = vector_to_array(column)
    return df.withColumns({f"{prefix}{n}": parts[i] for i, n in enumerate(names)})


def label_table(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Label text and index with its count, as fitted."""
    return (
        model.transform(df)
        .groupBy("tip_label", "label")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
