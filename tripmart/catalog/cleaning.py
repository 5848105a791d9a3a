"""Cleaning rules, one by one and together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.catalog.common import (
    RUN_MONTH,
    big,
    dollars,
    in_months,
    plain,
    project,
    sample_silver,
    sample_trips,
    with_tables,
)
from tripmart.config import MONEY_COLUMNS, TripContract
from tripmart.operators import silver as cleaning


def _repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.repair(sample_trips(spark, sf_dir))


def _derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.derive(_repaired(spark, sf_dir), TripContract(), None)


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(sample_silver(spark, sf_dir).drop("processed_at"))


def silver_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(
        _repaired(spark, sf_dir),
        "trip_key", "VendorID", "RatecodeID", "PULocationID", "DOLocationID", "payment_type",
    )


def silver_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(_repaired(spark, sf_dir), "trip_key", "store_and_fwd_flag", "passenger_count")


def silver_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    others = [c for c in MONEY_COLUMNS if c != "tip_amount"]
    return project(_repaired(spark, sf_dir), "trip_key", *others)


def silver_tip_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(_repaired(spark, sf_dir), "trip_key", "payment_type", "tip_amount")


def silver_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(
        _derived(spark, sf_dir),
        "trip_key", "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_duration_minutes",
    )


def silver_total_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(
        _derived(spark, sf_dir), "trip_key", "total_amount", "calculated_total", "is_total_correct"
    )


def silver_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(
        sample_silver(spark, sf_dir, RUN_MONTH), "trip_key", "tpep_pickup_datetime", "year", "month"
    )


def reject_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.reject_audit(sample_trips(spark, sf_dir))


def reject_audit_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of the whole table against one month: other pickups are strays."""
    return cleaning.reject_audit(sample_trips(spark, sf_dir), RUN_MONTH)


def reject_audit_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.reject_audit(sample_trips(spark, sf_dir), by=("PULocationID",))


QUERIES = {
    "silver_clean": silver_clean,
    "silver_ids": silver_ids,
    "silver_flags": silver_flags,
    "silver_money": silver_money,
    "silver_tip_rule": silver_tip_rule,
    "silver_duration": silver_duration,
    "silver_total_check": silver_total_check,
    "silver_month": silver_month,
    "reject_audit": reject_audit,
    "reject_audit_month": reject_audit_month,
    "reject_audit_zones": reject_audit_zones,
}

_OTHER_MONEY = ", ".join(
    f"{dollars(c + '_raw_c')} AS {c}" for c in MONEY_COLUMNS if c != "tip_amount"
)
_MINUTES = "seconds / 60.0"


def audit_sql(in_month: str, group: str = "") -> str:
    bad = {
        "distance_positive": "NOT COALESCE(trip_distance > 0, FALSE)",
        "distance_finite": "NOT COALESCE(trip_distance <= 1e9, FALSE)",
        "rate_code_known": "NOT COALESCE(RatecodeID BETWEEN 1 AND 6, FALSE)",
        "fare_positive": "NOT COALESCE(fare_c > 0, FALSE)",
        "pickup_in_month": f"NOT COALESCE({in_month}, FALSE)",
        "duration_positive": "COALESCE(seconds <= 0, FALSE)",
    }
    kept = " AND ".join(f"NOT ({t})" for n, t in bad.items() if n != "duration_positive")
    tests = bad | {"kept_rows": kept, "all_rows": "TRUE"}
    head = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    return "\nUNION ALL\n".join(
        f"SELECT {head}'{n}' AS rule, {big(f'COUNT(*) FILTER (WHERE {t})')} AS row_count FROM derived{tail}"
        for n, t in tests.items()
    )


ORACLE = {
    "silver_clean": with_tables(
        "silver",
        f"""SELECT trip_key, VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
 trip_distance, RatecodeID, store_and_fwd_flag, PULocationID, DOLocationID, payment_type,
 {_OTHER_MONEY}, {dollars("tip_c")} AS tip_amount, {_MINUTES} AS trip_duration_minutes,
 {dollars("calc_c")} AS calculated_total, is_total_correct, year, month FROM silver""",
    ),
    "silver_ids": with_tables(
        "repaired",
        """SELECT trip_key, VendorID, RatecodeID, PULocationID, DOLocationID, payment_type
 FROM repaired""",
    ),
    "silver_flags": with_tables(
        "repaired", "SELECT trip_key, store_and_fwd_flag, passenger_count FROM repaired"
    ),
    "silver_money": with_tables("repaired", f"SELECT trip_key, {_OTHER_MONEY} FROM repaired"),
    "silver_tip_rule": with_tables(
        "derived", f"SELECT trip_key, payment_type, {dollars('tip_c')} AS tip_amount FROM derived"
    ),
    "silver_duration": with_tables(
        "derived",
        f"""SELECT trip_key, tpep_pickup_datetime, tpep_dropoff_datetime,
 {_MINUTES} AS trip_duration_minutes FROM derived""",
    ),
    "silver_total_check": with_tables(
        "derived",
        f"""SELECT trip_key, {dollars("total_c")} AS total_amount, {dollars("calc_c")} AS calculated_total,
 total_c = calc_c AS is_total_correct FROM derived""",
    ),
    "silver_month": with_tables(
        "silver",
        f"""SELECT trip_key, tpep_pickup_datetime, year, month FROM silver
 WHERE {in_months("tpep_pickup_datetime", RUN_MONTH)}""",
    ),
    "reject_audit": with_tables("derived", audit_sql("tpep_pickup_datetime IS NOT NULL")),
    "reject_audit_month": with_tables(
        "derived", audit_sql(in_months("tpep_pickup_datetime", RUN_MONTH))
    ),
    "reject_audit_zones": with_tables(
        "derived",
        audit_sql("tpep_pickup_datetime IS NOT NULL", "PULocationID"),
    ),
}
