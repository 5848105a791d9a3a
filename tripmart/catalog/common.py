"""Shared inputs of the queries, and the same inputs in check SQL.

The check SQL works on whole cents, whole seconds and 1/10000 distance units
and rounds quotients once, half up, on integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import MONEY_COLUMNS, Months
from tripmart.operators import gold as mart
from tripmart.operators import silver as cleaning
from tripmart.session import scratch_path, small_scans
from tripmart.sources.lake import Lake, overwrite_partitions
from tripmart.sources.sample import trips, trips_sql

YEAR, MONTH = 1998, 3
RUN_MONTH = Months.of(YEAR, MONTH)
WINDOW = 6
HISTORY = Months.between("1995-01", "2001-12")


# -- inputs -----------------------------------------------------------------


def sample_trips(spark: SparkSession, sf_dir: str, months: Months | None = None) -> DataFrame:
    return trips(spark, sf_dir, months)


def sample_silver(spark: SparkSession, sf_dir: str, months: Months | None = None) -> DataFrame:
    return cleaning.clean(trips(spark, sf_dir, months), months)


def sample_gold(spark: SparkSession, sf_dir: str, months: Months | None = None) -> DataFrame:
    return mart.zone_day(sample_silver(spark, sf_dir, months))


def sample_lake(spark: SparkSession) -> Lake:
    return Lake(scratch_path(spark, "lake"))


def sample_landing(spark: SparkSession, sf_dir: str, months: Months | None = None) -> str:
    """A landing folder with one ``...YYYY-MM.parquet`` file set per month."""
    root = scratch_path(spark, "landing")
    table = trips(spark, sf_dir, months)
    if months is not None:
        table = table.where(F.date_format("tpep_pickup_datetime", "yyyy-MM") == months.start_day[:7])
    land(table, root)
    return root


def month_file(pickup: Column) -> Column:
    """``YYYY-MM.parquet`` of a pickup; a date pattern runs only for years of other than four digits."""
    year, month = F.year(pickup), F.lpad(F.month(pickup).cast("string"), 2, "0")
    plainly = F.concat(year.cast("string"), F.lit("-"), month)
    text = F.when(year.between(1000, 9999), plainly).otherwise(F.date_format(pickup, "yyyy-MM"))
    return F.concat(text, F.lit(".parquet"))


def land(table: DataFrame, root: str, mode: str = "append") -> None:
    """Trips as files of the months of their pickups, added to a landing folder."""
    pickup = F.col("tpep_pickup_datetime")
    # Months are told apart by a number on the way; the name of the file is made where it is written.
    numbered = table.withColumn("trips", F.year(pickup) * 12 + F.month(pickup))
    rows = numbered.hint("rebalance", F.col("trips")).withColumn("trips", month_file(pickup))
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("trips")
    with small_scans(table.sparkSession):
        writer.parquet(root)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with another engine."""
    casts = {
        name: F.col(name).cast("double") for name, t in df.dtypes if t.startswith("decimal")
    }
    return df.withColumns(casts) if casts else df


def project(df: DataFrame, *columns: str) -> DataFrame:
    return plain(df.select(*columns))


# -- the same in SQL --------------------------------------------------------


def half_up(n: str, d: str) -> str:
    """Two-decimal half-up value of ``n / d``; null for ``d`` = 0."""
    d = f"NULLIF({d}, 0)"
    return (
        f"CAST((CASE WHEN ({n}) < 0 THEN -((200 * (-({n})) + ({d})) // (2 * ({d})))"
        f" ELSE (200 * ({n}) + ({d})) // (2 * ({d})) END) / 100.0 AS DOUBLE)"
    )


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def dollars(cents: str) -> str:
    return f"CAST(({cents}) / 100.0 AS DOUBLE)"


def _cents(c: str) -> str:
    return f"CAST(ROUND(100 * COALESCE({c}, 0)) AS BIGINT) AS {c}_raw_c"


TRIPS = f"trips AS ({trips_sql()})"

REPAIRED = f"""repaired AS (
 SELECT trip_key, CAST(VendorID AS INT) AS VendorID, tpep_pickup_datetime, tpep_dropoff_datetime,
  CAST(CASE WHEN passenger_count = 0 THEN 1 ELSE passenger_count END AS INT) AS passenger_count,
  trip_distance, CAST(RatecodeID AS INT) AS RatecodeID,
  COALESCE(store_and_fwd_flag = 'Y', FALSE) AS store_and_fwd_flag,
  CAST(PULocationID AS INT) AS PULocationID, CAST(DOLocationID AS INT) AS DOLocationID,
  CAST(payment_type AS INT) AS payment_type,
  {", ".join(_cents(c) for c in MONEY_COLUMNS)},
  CAST(epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime) AS BIGINT) AS seconds
 FROM trips)"""

DERIVED = """derived AS (
 SELECT *, fare_amount_raw_c AS fare_c, total_amount_raw_c AS total_c,
  CASE WHEN payment_type = 1 THEN tip_amount_raw_c ELSE 0 END AS tip_c,
  fare_amount_raw_c + extra_raw_c + mta_tax_raw_c
   + CASE WHEN payment_type = 1 THEN tip_amount_raw_c ELSE 0 END
   + tolls_amount_raw_c + improvement_surcharge_raw_c + congestion_surcharge_raw_c
   + airport_fee_raw_c AS calc_c,
  CAST(year(tpep_pickup_datetime) AS INT) AS year,
  CAST(month(tpep_pickup_datetime) AS INT) AS month
 FROM repaired)"""

SILVER = """silver AS (
 SELECT *, total_c = calc_c AS is_total_correct FROM derived
 WHERE trip_distance > 0 AND trip_distance <= 1e9 AND RatecodeID BETWEEN 1 AND 6 AND fare_c > 0
  AND tpep_pickup_datetime IS NOT NULL)"""

GOLD_SUMS = """gold_sums AS (
 SELECT CAST(tpep_pickup_datetime AS DATE) AS pickup_date, PULocationID,
  COUNT(*) AS row_count, COUNT(VendorID) AS total_trips,
  COUNT(*) FILTER (WHERE NOT is_total_correct) AS flagged,
  SUM(total_c) AS total_c, SUM(tip_c) AS tip_c, SUM(fare_c) AS fare_c,
  SUM(CAST(ROUND(trip_distance * 10000) AS BIGINT)) AS distance_u,
  SUM(passenger_count) AS passengers, SUM(seconds) AS seconds, COUNT(seconds) AS seconds_n
 FROM silver GROUP BY ALL)"""

GOLD = f"""gold AS (
 SELECT pickup_date, PULocationID, {big("row_count")} AS row_count,
  {big("total_trips")} AS total_trips, {big("flagged")} AS flagged_incorrect_trips,
  {dollars("total_c")} AS total_revenue,
  {half_up("total_c", "row_count * 100")} AS avg_revenue,
  {dollars("tip_c")} AS total_tips_profit,
  CASE WHEN fare_c > 0 THEN {half_up("tip_c * 100", "fare_c")} ELSE 0.0 END AS tip_efficiency_pct,
  {half_up("distance_u", "row_count * 10000")} AS avg_distance,
  {big("passengers")} AS total_passengers_transported,
  {half_up("seconds", "seconds_n * 60")} AS avg_duration_minutes,
  {half_up("(total_trips - flagged) * 100", "total_trips")} AS data_trust_score,
  CAST(year(pickup_date) AS INT) AS year, CAST(month(pickup_date) AS INT) AS month
 FROM gold_sums)"""

# Two-decimal mart metrics back to whole hundredths.
GOLD_CENTS = """gold_cents AS (
 SELECT *, CAST(ROUND(total_revenue * 100) AS BIGINT) AS revenue_c,
  CAST(ROUND(total_tips_profit * 100) AS BIGINT) AS tips_c
 FROM gold)"""

PROFILE = """profile AS (
 SELECT PULocationID,
  CAST(SUM(CAST(ROUND(avg_revenue * 100) AS BIGINT)) AS DOUBLE) / (COUNT(avg_revenue) * 100) AS avg_revenue,
  CAST(SUM(CAST(ROUND(avg_distance * 100) AS BIGINT)) AS DOUBLE) / (COUNT(avg_distance) * 100) AS avg_distance,
  CAST(SUM(CAST(ROUND(avg_duration_minutes * 100) AS BIGINT)) AS DOUBLE) / (COUNT(avg_duration_minutes) * 100) AS avg_duration_minutes,
  CAST(SUM(CAST(ROUND(tip_efficiency_pct * 100) AS BIGINT)) AS DOUBLE) / (COUNT(tip_efficiency_pct) * 100) AS avg_tip_efficiency,
  CAST(SUM(total_trips) AS DOUBLE) AS total_trips
 FROM {source} GROUP BY PULocationID)"""

_CHAIN = {
    "trips": TRIPS,
    "repaired": REPAIRED,
    "derived": DERIVED,
    "silver": SILVER,
    "gold_sums": GOLD_SUMS,
    "gold": GOLD,
    "gold_cents": GOLD_CENTS,
}


def with_tables(upto: str, body: str, extra: str = "") -> str:
    """``body`` after the common tables up to ``upto`` (and ``extra`` ones)."""
    names = list(_CHAIN)
    parts = [_CHAIN[n] for n in names[: names.index(upto) + 1]]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n" + body


def in_months(column: str, months: Months) -> str:
    return (
        f"{column} >= TIMESTAMP '{months.start_day}' AND {column} < TIMESTAMP '{months.stop_day}'"
    )
