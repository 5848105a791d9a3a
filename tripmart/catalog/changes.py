"""Files that change, gaps, bad numbers, empty results and repeated fits."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.catalog.cleaning import audit_sql
from tripmart.catalog.common import (
    HISTORY,
    MONTH,
    RUN_MONTH,
    WINDOW,
    YEAR,
    big,
    land,
    plain,
    project,
    sample_gold,
    sample_lake,
    sample_landing,
    sample_silver,
    sample_trips,
    with_tables,
)
from tripmart.config import ModelConfig, Months, TripContract
from tripmart.operators import features, models, windows
from tripmart.operators import gold as mart
from tripmart.operators import silver as cleaning
from tripmart.plans import elt
from tripmart.session import materialise, scratch_path
from tripmart.sources import landing as files
from tripmart.sources.contract import RESCUED
from tripmart.sources.lake import overwrite_partitions, overwrite_run, read_table, stored_partitions
from tripmart.sources.sample import trips
from tripmart.streaming.months import follow_landing

AS_OF = dt.date(2002, 6, 1)
LATER = "1998-07-01"
BEFORE, AFTER = Months.between("1995-01", "1998-06"), Months.between("1998-07", "2001-12")
GAP = "1997-05"
GATE_DAY = dt.date(1998, 4, 1)
SURCHARGE = TripContract()
SURCHARGE = replace(
    SURCHARGE,
    columns=SURCHARGE.columns | {"night_surcharge": "double"},
    money=(*SURCHARGE.money, "night_surcharge"),
    components=(*SURCHARGE.components, "night_surcharge"),
)
CFG = ModelConfig(forest_layout=4)


def _two_eras(spark: SparkSession, sf_dir: str, **later) -> tuple[str, DataFrame, DataFrame]:
    """A new landing folder, and trips before and after the change, which adds ``later``."""
    # Each side is landed by a job of its own, which joins the orders of that side only.
    first = F.col("tpep_pickup_datetime") < F.lit(LATER)
    old, new = trips(spark, sf_dir, before=LATER), trips(spark, sf_dir, since=LATER)
    return scratch_path(spark, "landing"), old.where(first), new.where(~first).withColumns(later)


def drift_new_surcharge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A component that later months have, loaded in a run of its own: nothing is flagged for it."""
    surcharge = {"night_surcharge": F.lit(0.75), "total_amount": F.col("total_amount") + 0.75}
    landing, first, second = _two_eras(spark, sf_dir, **surcharge)
    lake = sample_lake(spark)
    for rows, months in ((first, BEFORE), (second, AFTER)):
        land(rows, landing)
        elt.backfill(spark, landing, lake, months, AS_OF, SURCHARGE)
    return project(
        read_table(spark, lake.gold), "pickup_date", "PULocationID", "total_trips", "flagged_incorrect_trips", "total_revenue"
    )


def drift_extra_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column outside the contract is kept in the cleaned table, and null before it came."""
    landing, first, second = _two_eras(spark, sf_dir, note=F.lit("new"))
    lake = sample_lake(spark)
    for rows, months in ((first, BEFORE), (second, AFTER)):
        land(rows, landing)
        elt.backfill(spark, landing, lake, months, AS_OF)
    return read_table(spark, lake.silver).groupBy("year", "month", "note").agg(F.count("*").alias("row_count"))


def drift_in_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each month has files of two schemas: other types, and a column that only one has."""
    landing, table = scratch_path(spark, "landing"), sample_trips(spark, sf_dir)
    land(table.where("trip_key < 50"), landing)
    land(
        table.where("trip_key >= 50").withColumns({"passenger_count": F.col("passenger_count").cast("bigint"), "note": F.lit("b")}),
        landing,
    )
    lake = sample_lake(spark)
    gate = elt.backfill(spark, landing, lake, HISTORY, AS_OF)
    assert files.ready_months(gate)
    return read_table(spark, lake.bronze).groupBy("passenger_count", "note").agg(
        F.count("*").alias("row_count"), F.sum("trip_key").alias("keys")
    )


def landing_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files below ``year=/month=`` folders."""
    pickup = F.col("tpep_pickup_datetime")
    landing, lake = scratch_path(spark, "landing"), sample_lake(spark)
    keyed = sample_trips(spark, sf_dir).withColumns({"year": F.year(pickup), "month": F.month(pickup)})
    overwrite_partitions(keyed, landing, rebalance=True)
    elt.backfill(spark, landing, lake, HISTORY, AS_OF)
    return read_table(spark, lake.bronze).groupBy("year", "month").agg(
        F.count("*").alias("row_count"), F.sum("trip_key").alias("keys")
    )


def rebuild_to_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month landed again with invalid fares only: its rows leave the layers above raw."""
    landing, lake = sample_landing(spark, sf_dir), sample_lake(spark)
    elt.backfill(spark, landing, lake, HISTORY, AS_OF)
    pickup = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    again = sample_trips(spark, sf_dir).where(pickup == RUN_MONTH.start_day[:7]).withColumn("fare_amount", F.lit(-1.0))
    land(again, landing, "overwrite")
    elt.backfill(spark, landing, lake, RUN_MONTH, AS_OF)
    layers = {"bronze": lake.bronze, "silver": lake.silver, "gold": lake.gold}
    counts = [
        read_table(spark, path).groupBy("year", "month").agg(F.count("*").alias("row_count")).withColumn("layer", F.lit(name))
        for name, path in layers.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def run_replaced_by_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs stored, the later one replaced by a run without rows."""
    path, gold = scratch_path(spark, "run"), plain(sample_gold(spark, sf_dir)).select("PULocationID", "total_trips")
    for month in (MONTH - 1, MONTH):
        overwrite_run(gold, path, YEAR, month, rebalance=True)
    overwrite_run(gold.where("total_trips < 0"), path, YEAR, MONTH, rebalance=True)
    return read_table(spark, path).groupBy("run_year", "run_month").agg(F.count("*").alias("row_count"))


def _bad_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = (
        F.when(F.col("trip_key") == 7, F.lit(float("nan"))).when(F.col("trip_key") == 8, F.lit(float("inf")))
        .when(F.col("trip_key") == 9, F.lit(1e16)).otherwise(F.col("trip_distance"))
    )
    return sample_trips(spark, sf_dir).withColumn("trip_distance", bad)


def silver_bad_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the audit counts where distances are not numbers, infinite or too large."""
    return cleaning.reject_audit(_bad_numbers(spark, sf_dir))


def gold_bad_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart of such trips."""
    return plain(mart.zone_day(cleaning.clean(_bad_numbers(spark, sf_dir))))


def gold_fine_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart of trips whose distances have six decimals: rounded once, as a mean, not one by one."""
    fine = F.expr("CAST(CAST(trip_distance AS DECIMAL(20,6)) + CAST(trip_key % 97 AS DECIMAL(10,0)) * 0.000014BD AS DOUBLE)")
    return plain(mart.zone_day(cleaning.clean(sample_trips(spark, sf_dir).withColumn("trip_distance", fine))))


def backfill_with_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month without a file: the others are loaded, the gate tells the gap."""
    landing, lake = scratch_path(spark, "landing"), sample_lake(spark)
    pickup = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    land(sample_trips(spark, sf_dir).where(pickup != GAP), landing)
    gate = elt.backfill(spark, landing, lake, Months.between("1997-01", "1998-06"), AS_OF)
    loaded = read_table(spark, lake.gold).groupBy("year", "month").agg(F.sum("row_count").alias("trips"))
    return gate.join(loaded, ["year", "month"], "left")


def stream_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing stream leaves out months that are too recent on its day."""
    landing, lake = sample_landing(spark, sf_dir), sample_lake(spark)
    follow_landing(spark, landing, lake, as_of=GATE_DAY).awaitTermination()
    return plain(read_table(spark, lake.gold))


def stream_deferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months too recent for a first run of the stream are loaded by one on a later day, without new files."""
    landing, lake = sample_landing(spark, sf_dir), sample_lake(spark)
    for day in (GATE_DAY, AS_OF):
        follow_landing(spark, landing, lake, as_of=day).awaitTermination()
    return plain(read_table(spark, lake.gold))


def _spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table of landed files whose passenger counts and distances are text, some of them no numbers."""
    landing, lake = scratch_path(spark, "landing"), sample_lake(spark)
    spoiled = {
        "passenger_count": F.when(F.col("trip_key") % 10 == 3, "many").otherwise(F.col("passenger_count").cast("string")),
        "trip_distance": F.when(F.col("trip_key") % 15 == 3, "3.x").otherwise(F.col("trip_distance").cast("string")),
    }
    land(sample_trips(spark, sf_dir).withColumns(spoiled), landing)
    elt.backfill(spark, landing, lake, HISTORY, AS_OF)
    return read_table(spark, lake.bronze)


def rescued_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of values that could not be cast, as they came, with the trips they belong to."""
    told = _spoiled(spark, sf_dir).select("trip_key", "passenger_count", "trip_distance", F.explode_outer(RESCUED).alias("column", "text"))
    return told.where("column IS NOT NULL").groupBy("column", "text").agg(
        F.count("*").alias("value_count"), F.sum("trip_key").alias("keys"), F.count("passenger_count").alias("passengers_known"),
        F.count("trip_distance").alias("distances_known"),
    )


def rescued_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of such a table: rows with rescued values, and values by column."""
    raw = _spoiled(spark, sf_dir)
    rows = cleaning.reject_audit(raw).where("rule IN ('values_cast', 'all_rows')").select("rule", "row_count")
    values = cleaning.rescued_counts(raw).select(F.col("column").alias("rule"), F.col("value_count").alias("row_count"))
    return rows.unionByName(values)


def listed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of a stored table from its listing alone."""
    lake = sample_lake(spark)
    overwrite_partitions(sample_gold(spark, sf_dir), lake.gold, rebalance=True)
    return stored_partitions(spark, lake.gold)


# -- fitted models: what must hold whatever the trainer does ---------------------


def _training(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    silver = materialise(sample_silver(spark, sf_dir), "silver")
    return windows.training_window(silver, RUN_MONTH, WINDOW), windows.prediction_window(silver, RUN_MONTH)


def fare_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip of the month is predicted, within the totals seen in training, better than by their mean."""
    past, now = _training(spark, sf_dir)
    train = materialise(features.fare_features(past, CFG), "train")
    scored = models.predict_fares(models.fit_fares(train, CFG), features.fare_features(now, CFG))
    low, high, mean = train.agg(F.min("total_amount"), F.max("total_amount"), F.avg("total_amount")).first()
    error = F.avg(F.pow(F.col("total_amount") - F.col("predicted_total_amount"), 2))
    plainly = F.avg(F.pow(F.col("total_amount") - mean, 2))
    return scored.agg(
        F.count("*").alias("row_count"),
        F.sum(F.rint(F.col("total_amount") * 100).cast("bigint")).alias("total_c"),
        F.min(F.col("predicted_total_amount").between(low, high)).alias("in_range"),
        (error < plainly).alias("beats_mean"),
    )


def tip_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per actual class, predicted texts that were learned, confidences of a three-way vote."""
    past, now = _training(spark, sf_dir)
    train = materialise(features.tip_features(past, CFG), "train")
    known = [r.tip_label for r in train.select("tip_label").distinct().collect()]
    scored = models.predict_tips(models.fit_tips(train, CFG), features.tip_features(now, CFG))
    return scored.groupBy("tip_label").agg(
        F.count("*").alias("row_count"),
        F.min(F.col("predicted_tip_label").isin(known)).alias("learned"),
        F.min(F.col("prediction_confidence").between(1 / 3 - 1e-9, 1 + 1e-9)).alias("confident"),
    )


def _grouping(assigned: DataFrame, by: str) -> DataFrame:
    """Rows with the smallest row of their group, so that numbers of groups do not matter."""
    first = assigned.groupBy("cluster").agg(F.min(by).alias("first"))
    return assigned.join(first, "cluster").select(by, "first")


def zone_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same grouping of zones from a profile in one and in seven partitions."""
    profile = materialise(features.zone_profile(sample_gold(spark, sf_dir)), "profile")
    one, seven = (
        _grouping(models.assign_zones(models.fit_zones(profile.repartition(n), CFG), profile, CFG), "PULocationID")
        for n in (1, 7)
    )
    same = one.join(seven.withColumnRenamed("first", "other"), "PULocationID")
    return same.agg(F.count("*").alias("zones"), F.min(F.col("first") == F.col("other")).alias("equal"))


def forest_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same predictions from training rows in two and in seven partitions."""
    past, now = _training(spark, sf_dir)
    train, month = materialise(features.fare_features(past, CFG), "train"), features.fare_features(now, CFG)
    totals = [
        models.predict_fares(models.fit_fares(train.repartition(n), CFG), month).agg(
            F.round(F.sum("predicted_total_amount"), 6)
        ).first()[0]
        for n in (2, 7)
    ]
    return spark.range(1).select(F.lit(totals[0] == totals[1]).alias("equal"))


def zone_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every zone is in one of the clusters, and at its nearest centre."""
    profile = materialise(features.zone_profile(sample_gold(spark, sf_dir)), "profile")
    model = models.fit_zones(profile, CFG)
    centres = [list(map(float, c)) for c in model.stages[-1].clusterCenters()]
    placed = model.transform(profile).withColumn("v", models.vector_to_array("features"))
    far = [
        F.aggregate(F.zip_with("v", F.array(*[F.lit(x) for x in c]), lambda a, b: F.pow(a - b, 2)), F.lit(0.0), lambda s, x: s + x)
        for c in centres
    ]
    nearest = F.array(*far)[F.col("cluster")] <= F.array_min(F.array(*far)) + 1e-9
    return placed.agg(
        F.count("*").alias("zones"), F.count_distinct("PULocationID").alias("different"),
        F.count_distinct("cluster").alias("clusters"), F.min(nearest).alias("at_nearest"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        drift_new_surcharge, drift_extra_column, drift_in_month, landing_folders, rebuild_to_empty, run_replaced_by_empty,
        silver_bad_numbers, gold_bad_numbers, gold_fine_distances, backfill_with_gap, stream_gated, stream_deferred, rescued_casts, rescued_audit,
        listed_months, fare_invariants, tip_invariants,
        zone_layouts, forest_layouts, zone_invariants,
    )
}

_BAD = (
    "CASE (l_orderkey * 31 + l_linenumber * 7) % 100 WHEN 7 THEN 'nan'::DOUBLE WHEN 8 THEN 'inf'::DOUBLE"
    " WHEN 9 THEN 1e16 ELSE l_quantity / 4 - 0.5 END AS trip_distance"
)


def _with_bad(sql: str) -> str:
    return sql.replace("l_quantity / 4 - 0.5 AS trip_distance", _BAD)


def _with_fine(sql: str) -> str:
    # Summed in millionths.
    fine = "l_quantity / 4 - 0.5 + (l_orderkey * 31 + l_linenumber * 7) % 100 % 97 * 0.000014 AS trip_distance"
    millionths = sql.replace("trip_distance * 10000)", "trip_distance * 1000000)").replace("row_count * 10000,", "row_count * 1000000,")
    return millionths.replace("l_quantity / 4 - 0.5 AS trip_distance", fine)


_MONTH_OF = "CAST(year(tpep_pickup_datetime) AS INT) AS year, CAST(month(tpep_pickup_datetime) AS INT) AS month"
_NOW = f"year = {YEAR} AND month = {MONTH}"
_TIP = """CASE WHEN tip_c * 100 > fare_c * 20 THEN 'Alta' WHEN tip_c * 100 >= fare_c * 5 THEN 'Media' ELSE 'Baja' END"""

ORACLE = {
    "drift_new_surcharge": with_tables(
        "gold",
        f"""SELECT pickup_date, PULocationID, total_trips, flagged_incorrect_trips,
 (CAST(ROUND(total_revenue * 100) AS BIGINT) + CASE WHEN pickup_date >= DATE '{LATER}' THEN 75 * row_count ELSE 0 END) / 100.0::DOUBLE
   AS total_revenue FROM gold""",
    ),
    "drift_extra_column": with_tables(
        "silver",
        f"""SELECT year, month, CASE WHEN tpep_pickup_datetime >= TIMESTAMP '{LATER}' THEN 'new' END AS note,
 COUNT(*) AS row_count FROM silver GROUP BY ALL""",
    ),
    "drift_in_month": with_tables(
        "trips",
        f"""SELECT passenger_count, CASE WHEN trip_key >= 50 THEN 'b' END AS note, COUNT(*) AS row_count,
 {big("SUM(trip_key)")} AS keys FROM trips GROUP BY ALL""",
    ),
    "landing_folders": with_tables(
        "trips", f"SELECT {_MONTH_OF}, COUNT(*) AS row_count, {big('SUM(trip_key)')} AS keys FROM trips GROUP BY ALL"
    ),
    "rebuild_to_empty": with_tables(
        "gold",
        f"""SELECT {_MONTH_OF}, COUNT(*) AS row_count, 'bronze' AS layer FROM trips GROUP BY ALL
 UNION ALL SELECT year, month, COUNT(*), 'silver' FROM silver WHERE NOT ({_NOW}) GROUP BY ALL
 UNION ALL SELECT year, month, COUNT(*), 'gold' FROM gold WHERE NOT ({_NOW}) GROUP BY ALL""",
    ),
    "run_replaced_by_empty": with_tables(
        "gold", f"SELECT {YEAR} AS run_year, {MONTH - 1} AS run_month, COUNT(*) AS row_count FROM gold"
    ),
    "silver_bad_numbers": _with_bad(with_tables("derived", audit_sql("tpep_pickup_datetime IS NOT NULL"))),
    "gold_fine_distances": _with_fine(with_tables("gold", "SELECT * FROM gold")),
    "gold_bad_numbers": _with_bad(with_tables("gold", "SELECT * FROM gold")),
    "backfill_with_gap": with_tables(
        "gold",
        f"""SELECT CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month,
 CASE WHEN strftime(m, '%Y-%m') = '{GAP}' THEN 'missing' ELSE 'ready' END AS status, {big("trips")} AS trips
 FROM range(TIMESTAMP '1997-01-01', TIMESTAMP '1998-07-01', INTERVAL 1 MONTH) r(m)
 LEFT JOIN (SELECT year AS y, month AS n, SUM(row_count) AS trips FROM gold GROUP BY ALL)
   ON y = year(m) AND n = month(m) AND strftime(m, '%Y-%m') <> '{GAP}'""",
    ),
    "stream_deferred": with_tables("gold", "SELECT * FROM gold"),
    "rescued_casts": with_tables(
        "trips",
        f"""SELECT 'passenger_count' AS "column", 'many' AS text, COUNT(*) AS value_count, {big("SUM(trip_key)")} AS keys,
 CAST(0 AS BIGINT) AS passengers_known, COUNT(CASE WHEN trip_key % 15 <> 3 THEN trip_distance END) AS distances_known
 FROM trips WHERE trip_key % 10 = 3
 UNION ALL SELECT 'trip_distance', '3.x', COUNT(*), {big("SUM(trip_key)")}, COUNT(CASE WHEN trip_key % 10 <> 3 THEN passenger_count END), 0
 FROM trips WHERE trip_key % 15 = 3""",
    ),
    "rescued_audit": with_tables(
        "trips",
        """SELECT 'values_cast' AS rule, COUNT(*) AS row_count FROM trips WHERE trip_key % 10 = 3 OR trip_key % 15 = 3
 UNION ALL SELECT 'all_rows', COUNT(*) FROM trips
 UNION ALL SELECT 'passenger_count', COUNT(*) FROM trips WHERE trip_key % 10 = 3
 UNION ALL SELECT 'trip_distance', COUNT(*) FROM trips WHERE trip_key % 15 = 3""",
    ),
    "listed_months": with_tables("gold", "SELECT DISTINCT year, month FROM gold"),
    "stream_gated": with_tables("gold", "SELECT * FROM gold WHERE year * 100 + month <= 199801"),
    "fare_invariants": with_tables(
        "silver",
        f"""SELECT COUNT(*) AS row_count, {big("SUM(total_c)")} AS total_c, TRUE AS in_range, TRUE AS beats_mean
 FROM silver WHERE {_NOW} AND passenger_count IS NOT NULL""",
    ),
    "tip_invariants": with_tables(
        "silver",
        f"""SELECT {_TIP} AS tip_label, COUNT(*) AS row_count, TRUE AS learned, TRUE AS confident
 FROM silver WHERE {_NOW} AND passenger_count IS NOT NULL GROUP BY ALL""",
    ),
    "zone_layouts": with_tables("gold", "SELECT COUNT(DISTINCT PULocationID) AS zones, TRUE AS equal FROM gold"),
    "forest_layouts": "SELECT TRUE AS equal",
    "zone_invariants": with_tables(
        "gold",
        """SELECT COUNT(DISTINCT PULocationID) AS zones, COUNT(DISTINCT PULocationID) AS different,
 CAST(4 AS BIGINT) AS clusters, TRUE AS at_nearest FROM gold""",
    ),
}
