"""Cleaning of raw trips: repair, rules, derived columns, reject audit."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.config import Months, TripContract
from tripmart.functions.calendar import in_range
from tripmart.sources.contract import RESCUED, align

MONEY_TYPE = "decimal(10,2)"
NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double"}


# -- repairs ----------------------------------------------------------------


def whole(column: str) -> Column:
    """Id column as int; anything that is not a number becomes null."""
    return F.col(column).try_cast("int")


def instant(column: str) -> Column:
    """Time column as timestamp; anything that is not a time becomes null."""
    return F.col(column).try_cast("timestamp")


def flag(column: str, yes: str) -> Column:
    return F.coalesce(F.col(column) == yes, F.lit(False))


def passengers(column: str) -> Column:
    """0 means "not entered" and counts as 1; null stays null."""
    count = F.col(column).try_cast("double")
    return F.when(count == 0, F.lit(1)).otherwise(count.try_cast("int"))


def money(column: str) -> Column:
    """Null is 0; cents are rounded half up; too large a number is null.

    A cast of a double to decimal goes through its text.  A value that is not
    near half a cent rounds the same way as plain binary arithmetic, so only
    the others (and those out of range) take the cast.
    """
    value = F.coalesce(F.col(column).try_cast("double"), F.lit(0.0))
    cents = value * 100
    nearest = F.rint(cents)
    by_cents = nearest.try_cast("bigint").try_cast("decimal(10,0)") * F.lit(Decimal("0.01"))
    return F.when(F.abs(cents - nearest) < 0.49, by_cents.try_cast(MONEY_TYPE)).otherwise(
        value.try_cast(MONEY_TYPE)
    )


def card_tip(tip: Column, payment: Column, card: int) -> Column:
    """Only card tips are reliable; all others, and unknown payments, are 0."""
    return F.when(payment == card, tip).otherwise(F.lit(0).cast(MONEY_TYPE))


def minutes_between(start: Column, end: Column) -> Column:
    """Whole seconds / 60; may be zero or negative."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60


def component_total(columns: tuple[str, ...]) -> Column:
    return reduce(add, [F.col(c) for c in columns]).try_cast(MONEY_TYPE)


# -- rules ------------------------------------------------------------------


def validity_rules(contract: TripContract) -> dict[str, Column]:
    """Rule name -> condition a repaired row must meet (null = not met)."""
    low, high = contract.rate_codes
    return {
        "distance_positive": F.col("trip_distance") > 0,
        "distance_finite": F.col("trip_distance") <= contract.distance_most,
        "rate_code_known": F.col("RatecodeID").between(low, high),
        "fare_positive": F.col("fare_amount") > 0,
    }


def raw_prefilter(raw: DataFrame, contract: TripContract, months: Months | None) -> Column:
    """Conditions on raw columns, each implied by a rule on repaired ones.

    They change no result; being plain comparisons of stored columns, they
    reach the Parquet scan and drop row groups and rows before any cast.
    """
    types = dict(raw.dtypes)
    low, high = contract.rate_codes
    tests = []
    if types["trip_distance"] in NUMERIC:
        tests.append(F.col("trip_distance") > 0)
    if types["RatecodeID"] in NUMERIC:
        tests.append((F.col("RatecodeID") >= low) & (F.col("RatecodeID") < high + 1))
    if types["fare_amount"] in NUMERIC:
        tests.append(F.col("fare_amount") > 0)
    pickup = types["tpep_pickup_datetime"]
    if months is not None and pickup in ("timestamp", "timestamp_ntz"):
        tests.append(in_range("tpep_pickup_datetime", months, pickup))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def repair(raw: DataFrame, contract: TripContract = TripContract()) -> DataFrame:
    """Typed columns without any filter.  Extra columns pass through."""
    aligned = align(raw, contract)
    ints = ("VendorID", "RatecodeID", "PULocationID", "DOLocationID", "payment_type")
    new = {c: whole(c) for c in ints}
    new["tpep_pickup_datetime"] = instant("tpep_pickup_datetime")
    new["tpep_dropoff_datetime"] = instant("tpep_dropoff_datetime")
    new["store_and_fwd_flag"] = flag("store_and_fwd_flag", contract.stored_flag)
    new["passenger_count"] = passengers("passenger_count")
    new |= {c: money(c) for c in contract.money}
    new["tip_amount"] = card_tip(
        money("tip_amount"), new["payment_type"], contract.card_payment
    )
    return aligned.withColumns(new)


def derive(repaired: DataFrame, contract: TripContract, processed_at: Column | None) -> DataFrame:
    """Duration, component total, consistency flag, processing time."""
    total = component_total(contract.components)
    return repaired.withColumns(
        {
            "trip_duration_minutes": minutes_between(
                F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
            ),
            "calculated_total": total,
            "is_total_correct": F.coalesce(F.col("total_amount") == total, F.lit(False)),
            "processed_at": F.current_timestamp() if processed_at is None else processed_at,
        }
    )


def month_rule(has_file_month: bool, months: Months | None) -> Column:
    """Keeps pickups in the wanted months and, where the month of the file is
    known (``year``/``month`` partition columns), in that month only."""
    pickup = F.col("tpep_pickup_datetime")
    rule = pickup.isNotNull()
    if months is not None:
        rule = in_range("tpep_pickup_datetime", months)
    if has_file_month:
        rule = rule & (F.year(pickup) == F.col("year")) & (F.month(pickup) == F.col("month"))
    return rule


def clean(
    raw: DataFrame,
    months: Months | None = None,
    contract: TripContract = TripContract(),
    processed_at: Column | None = None,
) -> DataFrame:
    """Raw trips to cleaned trips, with ``year`` and ``month`` keys.

    Row-local from end to end: one scan, no shuffle, for one month as for a
    whole history.
    """
    has_file_month = {"year", "month"} <= set(raw.columns)
    rules = reduce(lambda a, b: a & b, validity_rules(contract).values())
    aligned = align(raw, contract)
    kept = (
        repair(aligned.where(raw_prefilter(aligned, contract, months)), contract)
        .where(rules)
        .where(month_rule(has_file_month, months))
    )
    silver = derive(kept, contract, processed_at)
    if has_file_month:
        return silver
    return silver.withColumns(
        {"year": F.year("tpep_pickup_datetime"), "month": F.month("tpep_pickup_datetime")}
    )


def rescued_counts(raw: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """How many values of each column could not be cast, of rows that were brought to the contract.

    ``column`` and ``value_count``; columns without such values give no row.
    """
    if RESCUED not in raw.columns:
        none = raw.select(*by, F.lit("").alias("column"), F.lit(0).cast("long").alias("value_count"))
        return none.where("false")
    names = raw.select(*by, F.explode(F.map_keys(RESCUED)).alias("column"))
    return names.groupBy(*by, "column").agg(F.count("*").alias("value_count"))


def reject_audit(
    raw: DataFrame,
    months: Months | None = None,
    contract: TripContract = TripContract(),
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Rows that fail each rule, and a warning count of durations <= 0.

    A row is counted under every rule it fails; where the raw table keeps texts of values
    that could not be cast, its rows with such values are counted as ``values_cast``, a
    warning too (``rescued_counts`` tells the columns).  All counts come from one
    aggregation pass and are turned into rows afterwards, so no row is copied.
    """
    has_file_month = {"year", "month"} <= set(raw.columns)
    table = repair(raw, contract)
    broken = {name: ~F.coalesce(ok, F.lit(False)) for name, ok in validity_rules(contract).items()}
    broken["pickup_in_month"] = ~F.coalesce(month_rule(has_file_month, months), F.lit(False))
    broken["duration_positive"] = F.coalesce(
        minutes_between(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")) <= 0,
        F.lit(False),
    )
    kept = ~reduce(lambda a, b: a | b, [c for n, c in broken.items() if n != "duration_positive"])
    if RESCUED in table.columns:
        broken["values_cast"] = F.col(RESCUED).isNotNull()
    counts = [F.count_if(test).alias(name) for name, test in broken.items()]
    counts += [F.count_if(kept).alias("kept_rows"), F.count(F.lit(1)).alias("all_rows")]
    wide = table.groupBy(*by).agg(*counts)
    names = [*broken, "kept_rows", "all_rows"]
    return wide.unpivot(list(by), names, "rule", "row_count")
