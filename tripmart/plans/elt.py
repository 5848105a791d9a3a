"""Raw to cleaned to mart, for one month or any run of months."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import Column, DataFrame, SparkSession

from tripmart.config import Months, Run, TripContract
from tripmart.functions.calendar import in_month_list
from tripmart.operators import gold as mart
from tripmart.operators import silver as cleaning
from tripmart.session import prepare
from tripmart.sources import landing as files
from tripmart.sources.lake import (
    Lake,
    file_inventory,
    month_inventory,
    overwrite_partitions,
    read_table,
    warn_if_empty,
)

log = logging.getLogger(__name__)


class MissingMonths(RuntimeError):
    """Requested months that are old enough to be published but not there."""


def build_silver(
    spark: SparkSession,
    lake: Lake,
    pairs: list[tuple[int, int]],
    contract: TripContract = TripContract(),
    processed_at: Column | None = None,
) -> None:
    """Clean the given raw months in one job.

    The raw table is laid out by month, and each row must lie in the month of
    its file, so tasks write the months they read: no shuffle.
    """
    span = Months.between("%d-%d" % pairs[0], "%d-%d" % pairs[-1])
    raw = read_table(spark, lake.bronze).where(in_month_list(pairs))
    overwrite_partitions(
        cleaning.clean(raw, span, contract, processed_at), lake.silver, rebuilt=pairs
    )


def build_gold(
    spark: SparkSession,
    lake: Lake,
    pairs: list[tuple[int, int]],
    contract: TripContract = TripContract(),
) -> None:
    """Aggregate the *stored* cleaned months; the cleaning is not repeated."""
    silver = read_table(spark, lake.silver).where(in_month_list(pairs))
    # A month of the mart is small, so it is gathered into few files.
    overwrite_partitions(mart.zone_day(silver, contract), lake.gold, rebalance=True, rebuilt=pairs)


def rebuild(
    spark: SparkSession,
    lake: Lake,
    pairs: list[tuple[int, int]],
    contract: TripContract = TripContract(),
    processed_at: Column | None = None,
) -> None:
    """Recompute cleaned and mart partitions of the given raw months.

    Running it again gives the same partitions and touches no others.
    """
    prepare(spark)
    pairs = sorted(pairs)
    if pairs:
        build_silver(spark, lake, pairs, contract, processed_at)
        build_gold(spark, lake, pairs, contract)


def backfill(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    months: Months,
    as_of: dt.date,
    contract: TripContract = TripContract(),
    processed_at: Column | None = None,
    strict: bool = False,
) -> DataFrame:
    """Load every loadable month of a range in one job per layer.

    Months that are too recent and older months without a file are left out and
    reported in the gate table, which is returned; with ``strict`` an older
    month without a file stops the run before anything is written.
    """
    prepare(spark)
    landed = month_inventory(file_inventory(spark, landing))
    gate = files.month_gate(landed, months, as_of)
    missing = files.missing_months(gate)
    if missing and strict:
        raise MissingMonths(f"no file for {missing} in {landing}")
    if missing:
        log.warning("no file for %s in %s", missing, landing)
    pairs = files.ready_months(gate)
    if not pairs:
        log.warning("nothing to load for %s up to %s", months.start_day, months.stop_day)
        return gate
    files.ingest(spark, landing, lake.bronze, pairs, contract)
    warn_if_empty(read_table(spark, lake.bronze).where(in_month_list(pairs)), lake.bronze)
    rebuild(spark, lake, pairs, contract, processed_at)
    return gate


def run_month(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    run: Run,
    contract: TripContract = TripContract(),
) -> bool:
    """One month of ELT; False if the month is too recent to load."""
    gate = backfill(spark, landing, lake, run.months, run.as_of, contract, strict=True)
    return bool(files.ready_months(gate))

