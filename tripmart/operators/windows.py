"""Time windows, sampling and the hold-out split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.config import ModelConfig, Months
from tripmart.functions.calendar import in_partitions, in_range


def trips_in(silver: DataFrame, months: Months) -> DataFrame:
    """Cleaned trips of a run of months.

    The partition columns select directories; the stored month keys agree with
    the pickup by construction, the time range only guards foreign tables.
    """
    kept = silver.where(in_range("tpep_pickup_datetime", months))
    if {"year", "month"} <= set(silver.columns):
        kept = kept.where(in_partitions(months))
    return kept


def training_window(silver: DataFrame, month: Months, length: int) -> DataFrame:
    """The ``length`` months before the run month; nothing on or after it."""
    return trips_in(silver, month.before(length))


def prediction_window(silver: DataFrame, month: Months) -> DataFrame:
    return trips_in(silver, month)


def mart_window(gold: DataFrame, month: Months, length: int) -> DataFrame:
    """Mart rows of the run month and the ``length`` months before it."""
    months = month.widened(length)
    kept = gold.where(in_range("pickup_date", months, "date"))
    if {"year", "month"} <= set(gold.columns):
        kept = kept.where(in_partitions(months))
    return kept


def mart_until(gold: DataFrame, month: Months) -> DataFrame:
    """All mart rows up to the end of the run month."""
    kept = gold.where(F.col("pickup_date") < F.lit(month.stop_day).cast("date"))
    if {"year", "month"} <= set(gold.columns):
        kept = kept.where(F.col("year") * 12 + F.col("month") - 1 < month.stop)
    return kept


def key_sample(df: DataFrame, key: Column, percent: int) -> DataFrame:
    """Repeatable sample: rows whose 0-99 key is below ``percent``."""
    return df.where(key < percent)


def holdout_split(
    df: DataFrame, key: Column, train_percent: int = ModelConfig.train_percent
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a 0-99 key.

    A row's side follows from the row alone, so it is the same on every
    recomputation and for every partitioning, and equal rows stay together.
    """
    return df.where(key < train_percent), df.where(key >= train_percent)
