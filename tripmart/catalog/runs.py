"""Whole runs: month, back-fill, stream, models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tripmart.catalog.common import (
    HISTORY,
    MONTH,
    YEAR,
    plain,
    sample_lake,
    sample_landing,
    sample_silver,
    with_tables,
)
from tripmart.config import Months, Run
from tripmart.plans import elt
from tripmart.plans import models as training
from tripmart.plans.month import run_full_month
from tripmart.sources import landing as files
from tripmart.sources.lake import file_inventory, in_run, month_inventory, overwrite_partitions, read_table
from tripmart.streaming.months import follow_landing, follow_raw_table

AS_OF = dt.date(2002, 6, 1)
RUN = Run(YEAR, MONTH, AS_OF)


def _landed(spark: SparkSession, landing: str) -> Months:
    """First to last month with a file."""
    rows = month_inventory(file_inventory(spark, landing)).collect()
    months = sorted((r.year, r.month) for r in rows)
    return Months.between("%d-%d" % months[0], "%d-%d" % months[-1])


def elt_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = sample_landing(spark, sf_dir)
    lake = sample_lake(spark)
    elt.run_month(spark, landing, lake, RUN)
    return plain(read_table(spark, lake.gold))


def backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = sample_landing(spark, sf_dir)
    lake = sample_lake(spark)
    elt.backfill(spark, landing, lake, _landed(spark, landing), AS_OF)
    return plain(read_table(spark, lake.gold))


def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months arrive in two waves; each wave is followed by the stream."""
    landing = sample_landing(spark, sf_dir)
    lake = sample_lake(spark)
    pairs = files.ready_months(files.month_gate(file_inventory(spark, landing), HISTORY, AS_OF))
    half = len(pairs) // 2
    for wave in (pairs[:half], pairs[half:]):
        files.ingest(spark, landing, lake.bronze, wave)
        follow_raw_table(spark, lake).awaitTermination()
    return plain(read_table(spark, lake.gold))


def landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All landed files found by the stream and loaded."""
    landing = sample_landing(spark, sf_dir)
    lake = sample_lake(spark)
    follow_landing(spark, landing, lake, as_of=AS_OF).awaitTermination()
    return plain(read_table(spark, lake.gold))


def ml_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All models of a month on a stored lake with the whole history; the stored metrics."""
    lake = sample_lake(spark)
    overwrite_partitions(sample_silver(spark, sf_dir), lake.silver, rebalance=True)
    elt.build_gold(spark, lake, HISTORY.pairs)
    training.run_models(spark, lake, RUN)
    return in_run(read_table(spark, lake.metrics), YEAR, MONTH)


def full_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History loaded, then the full run of a month; the stored forecast."""
    landing = sample_landing(spark, sf_dir)
    lake = sample_lake(spark)
    elt.backfill(spark, landing, lake, _landed(spark, landing), AS_OF)
    run_full_month(spark, landing, lake, RUN)
    return in_run(read_table(spark, lake.forecasts), YEAR, MONTH)


QUERIES = {
    "elt_month": elt_month,
    "backfill_range": backfill_range,
    "stream_equals_batch": stream_equals_batch,
    "landing_stream": landing_stream,
    "ml_month": ml_month,
    "full_month": full_month,
}

ORACLE = {
    "elt_month": with_tables("gold", f"SELECT * FROM gold WHERE year = {YEAR} AND month = {MONTH}"),
    "backfill_range": with_tables("gold", "SELECT * FROM gold"),
    "stream_equals_batch": with_tables("gold", "SELECT * FROM gold"),
    "landing_stream": with_tables("gold", "SELECT * FROM gold"),
}
