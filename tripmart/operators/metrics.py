"""Model quality as rows: RMSE, accuracy, weighted F1, metric table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRIC_COLUMNS = ("run_year", "run_month", "model", "metric", "value")


def rmse(df: DataFrame, actual: Column, predicted: Column) -> DataFrame:
    error = actual.cast("double") - predicted.cast("double")
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows per (actual, predicted) pair; at most classes x classes rows."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def class_scores(matrix: DataFrame) -> DataFrame:
    """Support, hits and F1 of every actual class, from a confusion matrix.

    Each cell counts once as an actual and once as a predicted class.
    """
    cells = matrix.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("c"), F.col("row_count").alias("s"), F.lit(0).cast("bigint").alias("p")),
                F.struct(F.col("predicted").alias("c"), F.lit(0).cast("bigint").alias("s"), F.col("row_count").alias("p")),
            )
        ).alias("x"),
        F.when(F.col("actual") == F.col("predicted"), F.col("row_count")).otherwise(0).alias("hit"),
    )
    # A diagonal cell is exploded twice, so half of its hits is summed.
    totals = cells.groupBy(F.col("x.c").alias("class")).agg(
        F.sum("x.s").alias("support"),
        F.sum("x.p").alias("predicted"),
        (F.sum("hit") / 2).cast("bigint").alias("hits"),
    )
    f1 = F.lit(2.0) * F.col("hits") / (F.col("support") + F.col("predicted"))
    return totals.select("class", "support", "predicted", "hits", f1.alias("f1"))


def classification_scores(matrix: DataFrame) -> DataFrame:
    """Accuracy and support-weighted F1 as one row; null without rows."""
    scores = class_scores(matrix)
    total = F.sum("support")
    return scores.agg(
        F.try_divide(F.sum("hits"), total).alias("accuracy"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), total).alias("weighted_f1"),
    )


def metric_rows(df: DataFrame, model: str, year: int, month: int) -> DataFrame:
    """A one-row frame of named metrics to ``(run, model, metric, value)``."""
    names = df.columns
    doubles = df.select(*[F.col(n).cast("double").alias(n) for n in names])
    return doubles.unpivot([], names, "metric", "value").select(
        F.lit(year).alias("run_year"),
        F.lit(month).alias("run_month"),
        F.lit(model).alias("model"),
        "metric",
        "value",
    )


def metric_table(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
