"""A trip table derived from the test tables.

All money is built from whole cents and all times from whole seconds, so any
engine computes the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.config import Months
from tripmart.sources.records import stored_bytes

# The columns used, so that no footer has to be read to plan a query.
LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string"
)
ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"

# Placeholders: {pick} and {drop} are the engine's way to add seconds.
TRIPS_SQL = """
SELECT
 (l_orderkey * 31 + l_linenumber * 7) % 100 AS trip_key,
 CAST(CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE 1 + l_suppkey % 2 END AS DOUBLE) AS VendorID,
 {pick} AS tpep_pickup_datetime,
 {drop} AS tpep_dropoff_datetime,
 CAST(CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE l_linenumber - 1 END AS DOUBLE) AS passenger_count,
 l_quantity / 4 - 0.5 AS trip_distance,
 CAST(CASE WHEN l_suppkey % 37 = 0 THEN NULL WHEN l_linenumber = 7 THEN 99 ELSE l_linenumber END AS DOUBLE) AS RatecodeID,
 CASE WHEN l_partkey % 29 = 0 THEN NULL WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
 1 + l_suppkey % 25 AS PULocationID,
 1 + o_custkey % 25 AS DOLocationID,
 CASE WHEN l_returnflag = 'N' THEN 2 + l_linenumber % 3 ELSE 1 END AS payment_type,
 fare_c / 100E0 AS fare_amount,
 (l_linenumber % 3) * 0.5E0 AS extra,
 0.5E0 AS mta_tax,
 tip_c / 100E0 AS tip_amount,
 tolls_c / 100E0 AS tolls_amount,
 1.0E0 AS improvement_surcharge,
 (fare_c + (l_linenumber % 3) * 50 + 50 + tip_c + tolls_c + 100 + COALESCE(cong_c, 0) + air_c
   + CASE WHEN l_suppkey % 11 = 0 THEN 1 ELSE 0 END) / 100E0 AS total_amount,
 cong_c / 100E0 AS congestion_surcharge,
 air_c / 100E0 AS Airport_fee
FROM (
 SELECT *,
  CASE WHEN l_partkey % 53 = 0 THEN -1 ELSE 1 END * gross_c AS fare_c,
  CAST(FLOOR(gross_c * CAST(ROUND(l_discount * 100) AS BIGINT) * 3 / 100E0) AS BIGINT) AS tip_c
 FROM (
  SELECT {hint} *,
   300 + CAST(l_quantity AS BIGINT) * 80 + CAST(FLOOR(l_extendedprice / 100E0) AS BIGINT) AS gross_c,
   CASE WHEN l_tax > 0.065E0 THEN 694 ELSE 0 END AS tolls_c,
   CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE 250 END AS cong_c,
   CASE WHEN l_linenumber = 2 THEN 175 ELSE 0 END AS air_c,
   (l_partkey * 37 + l_linenumber * 613) % 86400 AS sec,
   (CAST(l_quantity AS BIGINT) * 97 + l_suppkey) % 5400 - 400 AS dur
  FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
 ) p
) q
"""

SPARK_TIMES = {
    "pick": "timestampadd(SECOND, sec, o_orderdate)",
    "drop": "timestampadd(SECOND, sec + dur, o_orderdate)",
}
# Both tables grow with the scale, so they are joined by a shuffle at every scale.
JOIN_HINT = "/*+ SHUFFLE_HASH(orders) */"
# Bytes of stored files of both tables that meet in one task of their join; sorted, they take 13 to
# 30 times as much memory.
JOINED_BYTES = 32 << 20
DUCKDB_TIMES = {
    "pick": "o_orderdate + to_seconds(sec)",
    "drop": "o_orderdate + to_seconds(sec + dur)",
}


def trips(
    spark: SparkSession,
    sf_dir: str,
    months: Months | None = None,
    since: str | None = None,
    before: str | None = None,
) -> DataFrame:
    """The derived trips, optionally only those that can touch ``months``.

    A pickup is 0 to 86399 seconds after the order date, so a month implies a
    range of order dates.  That range cuts the orders scan before the join;
    the exact month filter is still the caller's.  So it is with ``since`` and ``before``,
    days that cut the orders a day off, on one side each.

    The tasks of the join grow with the stored files, so what one task holds does not.
    """
    stored = f"{sf_dir}/lineitem.parquet", f"{sf_dir}/orders.parquet"
    lineitem = spark.read.schema(LINEITEM).parquet(stored[0])
    orders = spark.read.schema(ORDERS).parquet(stored[1])
    if months is not None:
        orders = orders.where(
            f"o_orderdate > timestamp_ntz'{months.start_day}' - interval 1 day"
            f" AND o_orderdate < timestamp_ntz'{months.stop_day}'"
        )
    if since is not None:
        orders = orders.where(f"o_orderdate > timestamp_ntz'{since}' - interval 1 day")
    if before is not None:
        orders = orders.where(f"o_orderdate < timestamp_ntz'{before}' + interval 1 day")
    # More tasks than the session's where those would hold too much of large tables.
    tasks = -(-sum(stored_bytes(spark, path) for path in stored) // JOINED_BYTES)
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        lineitem, orders = lineitem.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    text = TRIPS_SQL.format(lineitem="{lineitem}", orders="{orders}", hint=JOIN_HINT, **SPARK_TIMES)
    return spark.sql(text, lineitem=lineitem, orders=orders)


def trips_sql() -> str:
    """The same table as a DuckDB query."""
    return TRIPS_SQL.format(lineitem="lineitem", orders="orders", hint="", **DUCKDB_TIMES)
