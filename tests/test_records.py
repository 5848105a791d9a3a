"""Schema records, rescued values, listings and months that wait."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from helpers import plan_of, raw_trips, same_rows
from tripmart.config import Months
from tripmart.operators import silver
from tripmart.sources import sample
from tripmart.sources.contract import RESCUED, align
from tripmart.sources.lake import (
    RUN_KEYS, Lake, newest_run, overwrite_partitions, overwrite_run, read_table, stored_partitions, stored_schema,
)
from tripmart.sources.records import read_record, stored_bytes, write_record
from tripmart.sources.schema import merged_schema
from tripmart.streaming.months import deferred_months, follow_landing

KEYS = ("year", "month")


def fields(schema):
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def jobs(spark, build):
    """Number of jobs that building a frame starts."""
    group = f"g{id(build)}"
    spark.sparkContext.setJobGroup(group, "build")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_records_are_replaced(spark, tmp_path):
    path = str(tmp_path / "a" / "_r.json")
    assert read_record(spark, path) is None
    for text in ("[1]", "", "é" * 3000):
        write_record(spark, path, text)
        assert read_record(spark, path) == text
    assert [p.name for p in (tmp_path / "a").iterdir() if not p.name.endswith(".crc")] == ["_r.json"]


def test_sizes_are_those_of_the_files(spark, tmp_path):
    assert stored_bytes(spark, f"{tmp_path}/none") == 0
    for name in ("a", "b"):
        (tmp_path / "t" / name).mkdir(parents=True)
        (tmp_path / "t" / name / "f").write_bytes(b"12345")
    assert stored_bytes(spark, f"{tmp_path}/t") == 10
    assert stored_bytes(spark, f"{tmp_path}/t/*/f") == 10
    assert stored_bytes(spark, f"{tmp_path}/t/b/f") == 5


def test_tasks_of_the_join_of_trips_grow_with_the_files(spark, tmp_path, monkeypatch):
    # Orders 0 and 50 to 59 have no lines, lines without a key or with one that no order has give no trips, order 7 is there twice.
    spark.range(60).union(spark.createDataFrame([(7,)], "id bigint")).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"), F.lit("1998-03-05").cast("timestamp_ntz").alias("o_orderdate")
    ).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    key = F.when(F.col("id") % 10 == 9, None).when(F.col("id") % 10 == 8, F.col("id") + 1000).otherwise(1 + F.col("id") % 49)
    spark.range(1000).select(
        key.alias("l_orderkey"), F.col("id").alias("l_partkey"), (F.col("id") % 7).alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        F.lit(4.0).alias("l_quantity"), F.col("id").cast("double").alias("l_extendedprice"), F.lit(0.05).alias("l_discount"),
        F.lit(0.02).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
    ).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plainly = sample.trips(spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" not in plan_of(plainly)
    size = sum(stored_bytes(spark, f"{tmp_path}/{t}.parquet") for t in ("lineitem", "orders"))
    monkeypatch.setattr(sample, "JOINED_BYTES", -(-size // (5 * tasks)))
    assert jobs(spark, lambda: sample.trips(spark, str(tmp_path))) == 0
    for narrowed in ({}, {"months": Months.of(1998, 3)}, {"since": "1998-03-01"}):
        many = sample.trips(spark, str(tmp_path), **narrowed)
        exchanges = re.findall(r"Arguments: hashpartitioning\(\w+#\w+, (\d+)\), (\w+)", plan_of(many))
        assert len(exchanges) == 2 and len(set(exchanges)) == 1 and exchanges[0][1] == "REPARTITION_BY_NUM"
        assert 4 * tasks < int(exchanges[0][0]) <= 5 * tasks
        assert many.count() > 0 and same_rows(plainly, many)


def test_merged_schema_grows_and_widens():
    old = StructType([StructField("a", IntegerType()), StructField("B", StringType(), False), StructField("year", LongType())])
    new = StructType([StructField("b", StringType()), StructField("A", LongType()), StructField("c", DoubleType()), StructField("month", StringType())])
    want = {"a": "bigint", "B": "string", "c": "double", "year": "int", "month": "int"}
    assert fields(merged_schema(old, new, KEYS)) == want
    assert fields(merged_schema(merged_schema(None, new, KEYS), old, KEYS))["A"] == "bigint"
    assert all(f.nullable for f in merged_schema(old, new, KEYS))
    with pytest.raises(ValueError, match="column c"):
        merged_schema(new, StructType([StructField("c", StringType())]), KEYS)


def test_a_table_is_read_by_its_record(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.range(3).select(F.col("id").cast("int").alias("n"), F.lit(2024).alias("year"), F.lit(1).alias("month"))
    two = spark.range(2).select("id", (F.col("id") + 2**40).alias("n"), F.lit("x").alias("note"), F.lit(2024).alias("year"), F.lit(2).alias("month"))
    overwrite_partitions(one, path)
    overwrite_partitions(two, path)
    assert fields(stored_schema(spark, path)) == {"n": "bigint", "id": "bigint", "note": "string", "year": "int", "month": "int"}
    assert jobs(spark, lambda: read_table(spark, path, Months.of(2030, 1))) == 0
    rows = sorted((r.month, r.n, r.note) for r in read_table(spark, path).collect())
    assert rows == [(1, 0, None), (1, 1, None), (1, 2, None), (2, 2**40, "x"), (2, 2**40 + 1, "x")]
    assert read_table(spark, path, Months.of(2030, 1)).isEmpty()
    with pytest.raises(ValueError):
        overwrite_partitions(one.withColumn("note", F.lit(1)), path)
    assert read_table(spark, path).count() == 5  # nothing was written


def test_a_table_without_a_record_gets_one(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.range(2).select("id", F.lit(2024).alias("year"), F.lit(1).alias("month"))
    old.write.partitionBy("year", "month").parquet(path)
    assert stored_schema(spark, path) is None and read_table(spark, path).count() == 2
    overwrite_partitions(old.select(F.lit("y").alias("note"), "year", F.lit(2).alias("month")), path)
    assert fields(stored_schema(spark, path)) == {"id": "bigint", "note": "string", "year": "int", "month": "int"}
    assert read_table(spark, path).where("id IS NOT NULL").count() == 2


def test_listing_gives_partitions_and_the_newest_run(spark, tmp_path):
    path, none = str(tmp_path / "runs"), str(tmp_path / "none")
    assert stored_partitions(spark, none).isEmpty() and newest_run(spark, none) is None
    for year, month in ((2023, 12), (2024, 2), (2024, 1)):
        overwrite_run(spark.range(1), path, year, month)
    listed = stored_partitions(spark, path, RUN_KEYS)
    assert "Scan binaryFile" in plan_of(listed) and "Scan parquet" not in plan_of(listed)
    assert {tuple(r) for r in listed.collect()} == {(2023, 12), (2024, 1), (2024, 2)}
    assert newest_run(spark, path) == (2024, 2)


def test_failed_casts_keep_their_text(spark):
    texts = raw_trips(spark, {}, {}, {}).withColumns({
        "passenger_count": F.element_at(F.array(F.lit("2"), F.lit("many"), F.lit(None)), F.col("id") + 1),
        "PULocationID": F.element_at(F.array(F.lit("3.0"), F.lit("3.x"), F.lit("")), F.col("id") + 1),
        "DOLocationID": F.element_at(F.array(F.lit(float("nan")), F.lit(4.0), F.lit(5.0)), F.col("id") + 1),
    })
    got = {r.id: r for r in align(texts).collect()}
    assert [(got[i].passenger_count, got[i].PULocationID) for i in range(3)] == [(2.0, 3), (None, None), (None, None)]
    assert got[1][RESCUED] == {"passenger_count": "many", "PULocationID": "3.x"} and got[2][RESCUED] == {"PULocationID": ""}
    again = align(align(texts).withColumn("trip_distance", F.when(F.col("id") == 1, "far").otherwise("2.5")))
    more = {r.id: r for r in again.collect()}
    assert more[1][RESCUED] == got[1][RESCUED] | {"trip_distance": "far"} and more[2][RESCUED] == got[2][RESCUED]
    assert {(r.column, r.value_count) for r in silver.rescued_counts(again.where("id > 0")).collect()} == {
        ("passenger_count", 1), ("PULocationID", 2), ("trip_distance", 1),
    }
    audit = {r.rule: r.row_count for r in silver.reject_audit(align(texts)).collect()}
    assert audit["values_cast"] == sum(r[RESCUED] is not None for r in got.values())


def test_files_that_fit_have_no_rescue_column(spark):
    assert RESCUED not in align(raw_trips(spark, {})).columns
    assert silver.rescued_counts(raw_trips(spark, {})).isEmpty()
    assert "values_cast" not in {r.rule for r in silver.reject_audit(raw_trips(spark, {})).collect()}


def test_months_wait_until_they_are_ready(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), Lake(str(tmp_path / "lake"))
    raw_trips(spark, {}).drop("id").write.parquet(f"{landing}/part/2024-01.parquet")
    for day, waiting in (((2024, 2, 1), [(2024, 1)]), ((2024, 3, 1), [(2024, 1)]), ((2024, 6, 1), []), ((2024, 7, 1), [])):
        follow_landing(spark, landing, lake, as_of=dt.date(*day)).awaitTermination()
        assert deferred_months(spark, lake) == waiting
    assert read_table(spark, lake.gold).count() == 1
