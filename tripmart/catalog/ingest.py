"""Sources, sinks and table layout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.catalog.common import (
    HISTORY,
    RUN_MONTH,
    big,
    dollars,
    project,
    sample_gold,
    sample_lake,
    sample_landing,
    sample_silver,
    sample_trips,
    with_tables,
)
from tripmart.config import Months
from tripmart.operators import silver as cleaning
from tripmart.sources import landing as files
from tripmart.sources.contract import RESCUED, union_drifted
from tripmart.sources.lake import (
    file_inventory,
    in_run,
    latest_run,
    month_inventory,
    overwrite_partitions,
    overwrite_run,
    read_table,
)

AS_OF = dt.date(2001, 9, 15)
WANTED = Months.between("1994-10", "2001-12")

RAW_SELECT = """SELECT trip_key, VendorID, tpep_pickup_datetime, tpep_dropoff_datetime,
 passenger_count, trip_distance, RatecodeID, store_and_fwd_flag, PULocationID, DOLocationID,
 CAST(payment_type AS BIGINT) AS payment_type, fare_amount, extra, mta_tax, tip_amount,
 tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
 Airport_fee AS airport_fee"""


def trips_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_trips(spark, sf_dir).withColumnRenamed("Airport_fee", "airport_fee")


def schema_drift_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three eras of files: ids as integers, no airport fee; texts; as is."""
    table = sample_trips(spark, sf_dir)
    year = F.year("tpep_pickup_datetime")
    first = (
        table.where(year <= 1996)
        .withColumns({c: F.col(c).cast("bigint") for c in ("VendorID", "passenger_count", "RatecodeID")})
        .drop("Airport_fee")
    )
    second = table.where((year > 1996) & (year <= 1998)).withColumns(
        {c: F.col(c).cast("string") for c in ("tpep_pickup_datetime", "passenger_count", "PULocationID")}
    )
    third = table.where(year > 1998)
    # No value of these texts fails its cast, so nothing is rescued; `rescued_casts` shows those that do.
    return union_drifted([first, second, third]).drop(RESCUED)


def month_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    pickup = F.col("tpep_pickup_datetime")
    landed = sample_trips(spark, sf_dir).select(
        F.year(pickup).alias("year"), F.month(pickup).alias("month")
    )
    return files.month_gate(landed, WANTED, AS_OF)


def file_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    inventory = file_inventory(spark, sample_landing(spark, sf_dir))
    return inventory.where("bytes > 0").select("year", "month").distinct()


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All landed months to the raw table and back, rows unchanged."""
    landing = sample_landing(spark, sf_dir)
    lake = sample_lake(spark)
    gate = files.month_gate(file_inventory(spark, landing), HISTORY, dt.date(2002, 6, 1))
    files.ingest(spark, landing, lake.bronze, files.ready_months(gate))
    return read_table(spark, lake.bronze)


def month_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = sample_lake(spark)
    overwrite_partitions(sample_gold(spark, sf_dir), lake.gold, rebalance=True)
    return month_inventory(read_table(spark, lake.gold))


SILVER_KEYS = (
    "trip_key", "tpep_pickup_datetime", "PULocationID", "total_amount",
    "is_total_correct", "year", "month",
)


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History written, one month replaced by itself, all read back."""
    lake = sample_lake(spark)
    overwrite_partitions(sample_silver(spark, sf_dir), lake.silver, rebalance=True)
    again = cleaning.clean(sample_trips(spark, sf_dir, RUN_MONTH), RUN_MONTH)
    overwrite_partitions(again, lake.silver)
    return project(read_table(spark, lake.silver), *SILVER_KEYS)


def partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition and column selecting scan of a stored table."""
    lake = sample_lake(spark)
    overwrite_partitions(sample_gold(spark, sf_dir), lake.gold, rebalance=True)
    return read_table(
        spark, lake.gold, Months.between("1997-11", "1998-02"), ["pickup_date", "PULocationID", "total_trips"]
    )


def run_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs stored, the first replaced; both runs and which is latest."""
    path = sample_lake(spark).table("ml/zone_totals")
    totals = sample_gold(spark, sf_dir).groupBy("PULocationID").agg(
        F.sum("total_trips").alias("total_trips")
    )
    overwrite_run(totals, path, 1998, 2, rebalance=True)
    overwrite_run(totals, path, 1998, 3, rebalance=True)
    overwrite_run(totals.withColumn("total_trips", F.col("total_trips") + 1), path, 1998, 2, rebalance=True)
    stored = read_table(spark, path)
    newest = latest_run(stored).withColumn("latest", F.lit(True))
    older = in_run(stored, 1998, 2).withColumn("latest", F.lit(False))
    return newest.unionByName(older)


QUERIES = {
    "trips_sample": trips_sample,
    "schema_drift_union": schema_drift_union,
    "month_gate": month_gate,
    "file_months": file_months,
    "bronze_roundtrip": bronze_roundtrip,
    "month_inventory": month_list,
    "silver_roundtrip": silver_roundtrip,
    "partition_scan": partition_scan,
    "run_partition_roundtrip": run_partition_roundtrip,
}

_MONTHS = """SELECT DISTINCT CAST(year(tpep_pickup_datetime) AS INT) AS year,
 CAST(month(tpep_pickup_datetime) AS INT) AS month FROM {table}"""

ORACLE = {
    "trips_sample": with_tables("trips", RAW_SELECT.replace("CAST(payment_type AS BIGINT) AS ", "") + " FROM trips"),
    "schema_drift_union": with_tables(
        "trips",
        RAW_SELECT.replace(
            "Airport_fee AS",
            "CASE WHEN year(tpep_pickup_datetime) <= 1996 THEN NULL ELSE Airport_fee END AS",
        )
        + " FROM trips",
    ),
    "month_gate": with_tables(
        "trips",
        f"""SELECT CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month,
  CASE WHEN m > DATE '{AS_OF}' - INTERVAL 90 DAY THEN 'too_recent'
       WHEN (year(m), month(m)) IN (SELECT (year(tpep_pickup_datetime), month(tpep_pickup_datetime)) FROM trips)
       THEN 'ready' ELSE 'missing' END AS status
 FROM (SELECT unnest(generate_series(TIMESTAMP '1994-10-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH)) AS m)""",
    ),
    "file_months": with_tables("trips", _MONTHS.format(table="trips")),
    "bronze_roundtrip": with_tables(
        "trips",
        RAW_SELECT
        + """, CAST(year(tpep_pickup_datetime) AS INT) AS year,
 CAST(month(tpep_pickup_datetime) AS INT) AS month FROM trips""",
    ),
    "month_inventory": with_tables("silver", _MONTHS.format(table="silver")),
    "silver_roundtrip": with_tables(
        "silver",
        f"""SELECT trip_key, tpep_pickup_datetime, PULocationID, {dollars("total_c")} AS total_amount,
 is_total_correct, year, month FROM silver""",
    ),
    "partition_scan": with_tables(
        "gold",
        """SELECT pickup_date, PULocationID, total_trips FROM gold
 WHERE pickup_date >= DATE '1997-11-01' AND pickup_date < DATE '1998-03-01'""",
    ),
    "run_partition_roundtrip": with_tables(
        "gold",
        f"""SELECT PULocationID, {big("SUM(total_trips) + 1 - n")} AS total_trips,
 1998 AS run_year, CAST(2 + n AS INT) AS run_month, n = 1 AS latest
 FROM gold, (VALUES (0), (1)) AS r(n) GROUP BY PULocationID, n""",
    ),
}
