import datetime as dt

import pytest
from helpers import plan_of, raw_trips, same_rows
from pyspark.sql import functions as F

from tripmart.catalog.common import month_file
from tripmart.config import RAW_COLUMNS, Months, Run, TripContract
from tripmart.operators import gold, silver
from tripmart.plans import elt
from tripmart.session import small_scans
from tripmart.sources import landing as files
from tripmart.sources.contract import align, union_drifted
from tripmart.sources.lake import (
    Lake,
    file_inventory,
    latest_run,
    month_inventory,
    overwrite_partitions,
    overwrite_run,
    read_table,
    warn_if_empty,
)
from tripmart.streaming.months import follow_landing, follow_raw_table

AS_OF = dt.date(2024, 12, 31)


def months_of_trips(spark, *months, rows=3):
    """``rows`` trips on days 1.. of every month."""
    changes = []
    for m in months:
        for d in range(1, rows + 1):
            changes.append(
                {
                    "tpep_pickup_datetime": f"{m}-{d:02d} 10:00:00",
                    "tpep_dropoff_datetime": f"{m}-{d:02d} 10:10:00",
                    "PULocationID": d % 2,
                }
            )
    return raw_trips(spark, *changes)


def land(df, root, month):
    df.where(F.date_format("tpep_pickup_datetime", "yyyy-MM") == month).coalesce(1).write.parquet(
        f"{root}/trips_{month}.parquet"
    )


def stored(spark, path):
    return read_table(spark, path)


def test_contract_is_complete_and_typed(spark):
    df = raw_trips(spark, {}).drop("airport_fee", "id").withColumnRenamed("fare_amount", "FARE_Amount")
    out = align(df)
    assert dict(out.dtypes) == RAW_COLUMNS
    assert out.first().airport_fee is None and out.first().fare_amount == 10.0


def test_aliases_map_other_names(spark):
    df = raw_trips(spark, {}).withColumnRenamed("tpep_pickup_datetime", "start_time")
    out = align(df, TripContract(aliases={"Start_Time": "tpep_pickup_datetime"}))
    assert out.first().tpep_pickup_datetime is not None and "start_time" not in out.columns


def test_drifted_frames_union(spark):
    base = raw_trips(spark, {"passenger_count": 2.0, "VendorID": 2.0})
    as_int = base.withColumns({c: F.col(c).cast("int") for c in ("passenger_count", "VendorID")})
    as_text = base.withColumns(
        {"PULocationID": F.lit("10.0"), "passenger_count": F.lit("many"), "extra_note": F.lit("x")}
    ).drop("congestion_surcharge")
    rows = union_drifted([base, as_int, as_text]).collect()
    assert [r.passenger_count for r in rows] == [2.0, 2.0, None]
    assert [r.PULocationID for r in rows] == [10, 10, 10]
    assert [r.congestion_surcharge for r in rows] == [2.5, 2.5, None]
    assert [r.extra_note for r in rows] == [None, None, "x"]


def test_gate_status(spark):
    landed = spark.createDataFrame([(2024, 1), (2024, 3), (2024, 11)], "year int, month int")
    gate = files.month_gate(landed, Months.between("2024-01", "2024-12"), AS_OF)
    status = {r.month: r.status for r in gate.collect()}
    assert status[1] == status[3] == "ready"
    assert status[2] == status[9] == "missing"
    # 90 days before the last day of 2024 is October 2.
    assert status[10] == "missing" and status[11] == status[12] == "too_recent"


def test_gate_boundary_day(spark):
    landed = spark.createDataFrame([(2024, 1)], "year int, month int")
    on = files.month_gate(landed, Months.of(2024, 1), dt.date(2024, 3, 31))
    before = files.month_gate(landed, Months.of(2024, 1), dt.date(2024, 3, 30))
    assert on.first().status == "ready" and before.first().status == "too_recent"


def test_overwrite_leaves_other_months_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "v int, year int, month int")
    overwrite_partitions(first, path, rebalance=True)
    overwrite_partitions(first.where("month = 2").withColumn("v", F.lit(9)), path)
    assert {(r.v, r.month) for r in stored(spark, path).collect()} == {(1, 1), (9, 2)}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_runs_are_kept_apart_and_the_latest_is_found(spark, tmp_path):
    path = str(tmp_path / "r")
    df = spark.createDataFrame([(1,)], "v int")
    for year, month in ((2023, 12), (2024, 1), (2024, 2), (2024, 1)):
        overwrite_run(df, path, year, month)
    table = stored(spark, path)
    assert table.count() == 3
    row = latest_run(table).collect()
    assert [(r.run_year, r.run_month) for r in row] == [(2024, 2)]


def test_partition_and_column_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(12).selectExpr("id a", "id b", "2024 year", "cast(id + 1 as int) month")
    overwrite_partitions(df, path)
    part = read_table(spark, path, Months.of(2024, 5), ["a"])
    assert [r.a for r in part.collect()] == [4]
    text = plan_of(part)
    assert "PartitionFilters: [isnotnull(year" in text and "ReadSchema: struct<a:bigint>" in text
    assert read_table(spark, path, Months.of(2030, 1)).isEmpty()


def test_empty_input_is_reported(spark, caplog):
    assert warn_if_empty(spark.range(0), "nothing")
    assert "nothing" in caplog.text
    assert not warn_if_empty(spark.range(1), "one")


def test_inventory_finds_months_in_names_and_folders(spark, tmp_path):
    root = str(tmp_path / "mixed")
    spark.range(1).coalesce(1).write.parquet(f"{root}/trips_2024-03.parquet")
    overwrite_partitions(spark.sql("SELECT 1 v, 2024 year, 7 month"), f"{root}/table")
    rows = file_inventory(spark, root).collect()
    assert {(r.year, r.month) for r in rows} == {(2024, 3), (2024, 7)}
    assert all(r.bytes > 0 for r in rows)


def test_ingest_keeps_rows_and_marks_the_file_month(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), Lake(str(tmp_path / "lake"))
    df = months_of_trips(spark, "2024-01", "2024-02")
    land(df, landing, "2024-01")
    drifted = df.withColumn("passenger_count", F.col("passenger_count").cast("bigint")).withColumnRenamed(
        "airport_fee", "Airport_fee"
    )
    land(drifted, landing, "2024-02")
    files.ingest(spark, landing, lake.bronze, [(2024, 1), (2024, 2)])
    bronze = stored(spark, lake.bronze)
    assert same_rows(df.select("id", "airport_fee", "passenger_count"), bronze)
    assert bronze.where(F.month("tpep_pickup_datetime") != F.col("month")).isEmpty()


def test_jobs_of_a_landing_read_do_not_grow_with_the_files(spark, tmp_path):
    df = months_of_trips(spark, "2024-01")
    other = df.withColumn("passenger_count", F.col("passenger_count").cast("string"))

    def jobs(count):
        root = str(tmp_path / f"landing {count}")
        for month in range(1, count + 1):
            (df, other)[month % 2].coalesce(1).write.parquet(f"{root}/trips_2024-{month:02d}.parquet")
        group = f"landing-{count}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            rows = files.read_landing(spark, root, [(2024, m) for m in range(1, count + 1)])
            found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert rows.groupBy("month").count().count() == count
        return found

    assert jobs(2) == jobs(8)


def test_footers_are_told_apart_by_their_schemas(spark, tmp_path):
    for name, kind in (("a", "int"), ("b", "int"), ("c", "bigint"), ("d", "timestamp"), ("e", "timestamp_ntz")):
        value = F.lit("2024-01-01").cast(kind) if kind.startswith("t") else F.lit(1).cast(kind)
        spark.range(3).select(value.alias("v")).coalesce(1).write.parquet(str(tmp_path / f"{name}_2024-01.parquet"))
    prints = {r.path.split("/")[-2][0]: r.footer for r in files.footer_prints(file_inventory(spark, str(tmp_path))).collect()}
    assert prints["a"] == prints["b"] and len(set(prints.values())) == 4 and None not in prints.values()
    unknown = spark.createDataFrame([("nowhere://host/x.parquet",)], "path string")
    assert files.footer_prints(unknown).first().footer is None


def test_month_run_gates_and_repeats(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), Lake(str(tmp_path / "lake"))
    df = months_of_trips(spark, "2024-01", "2024-02", "2024-11")
    for m in ("2024-01", "2024-02", "2024-11"):
        land(df, landing, m)
    assert elt.run_month(spark, landing, lake, Run(2024, 1, AS_OF))
    assert elt.run_month(spark, landing, lake, Run(2024, 2, AS_OF))
    once = stored(spark, lake.gold).collect()
    assert elt.run_month(spark, landing, lake, Run(2024, 1, AS_OF))
    assert sorted(stored(spark, lake.gold).collect()) == sorted(once)
    assert not elt.run_month(spark, landing, lake, Run(2024, 11, AS_OF))
    with pytest.raises(elt.MissingMonths):
        elt.run_month(spark, landing, lake, Run(2024, 3, AS_OF))
    assert month_inventory(stored(spark, lake.gold)).count() == 2


def test_backfill_equals_month_by_month_and_one_pass(spark, tmp_path):
    landing = str(tmp_path / "landing")
    names = ["2023-11", "2023-12", "2024-01"]
    df = months_of_trips(spark, *names)
    for m in names:
        land(df, landing, m)
    stray = raw_trips(spark, {"tpep_pickup_datetime": "2023-11-15 00:00:00"}, {})
    stray.coalesce(1).write.mode("append").parquet(f"{landing}/trips_2024-01.parquet")
    whole, steps = Lake(str(tmp_path / "whole")), Lake(str(tmp_path / "steps"))
    elt.backfill(spark, landing, whole, Months.between("2023-11", "2024-01"), AS_OF)
    for y, m in ((2023, 11), (2023, 12), (2024, 1)):
        elt.run_month(spark, landing, steps, Run(y, m, AS_OF))
    a, b = stored(spark, whole.gold), stored(spark, steps.gold)
    assert same_rows(a, b)
    # The stray November row of the January file is dropped, the good one kept.
    assert a.agg(F.sum("row_count")).first()[0] == 10
    direct = gold.zone_day(silver.clean(df.unionByName(stray.where("id = 1"))))
    assert same_rows(a, direct)


def test_silver_is_written_without_a_shuffle(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    df = months_of_trips(spark, "2024-01").withColumns({"year": F.lit(2024), "month": F.lit(1)})
    overwrite_partitions(df, lake.bronze)
    plan = plan_of(silver.clean(stored(spark, lake.bronze), Months.of(2024, 1)))
    assert "Exchange" not in plan


def test_stream_equals_batch_when_a_month_arrives_in_parts(spark, tmp_path):
    lake, batch = Lake(str(tmp_path / "stream")), Lake(str(tmp_path / "batch"))
    df = months_of_trips(spark, "2024-01", "2024-02", rows=6).withColumns(
        {"year": F.year("tpep_pickup_datetime"), "month": F.month("tpep_pickup_datetime")}
    )
    overwrite_partitions(df, batch.bronze)
    elt.rebuild(spark, batch, [(2024, 1), (2024, 2)])
    waves = ("id < 4", "id >= 4 AND id < 9", "id >= 9")
    for wave in waves:
        df.where(wave).coalesce(1).write.mode("append").partitionBy("year", "month").parquet(lake.bronze)
        follow_raw_table(spark, lake).awaitTermination()
    assert same_rows(stored(spark, batch.gold), stored(spark, lake.gold))
    # Nothing new: the next start has nothing to do.
    before = {r.path: r.modified for r in file_inventory(spark, lake.gold).collect()}
    follow_raw_table(spark, lake).awaitTermination()
    assert {r.path: r.modified for r in file_inventory(spark, lake.gold).collect()} == before


def test_landing_stream_loads_each_month_once_it_arrives(spark, tmp_path):
    landing, lake = str(tmp_path / "landing"), Lake(str(tmp_path / "lake"))
    other = Lake(str(tmp_path / "batch"))
    df = months_of_trips(spark, "2024-01", "2024-02", rows=6)
    land(df.where("id < 3"), landing, "2024-01")
    follow_landing(spark, landing, lake).awaitTermination()
    assert stored(spark, lake.gold).agg(F.sum("row_count")).first()[0] == 3
    # The rest of January and all of February.
    df.where("id >= 3 AND id < 6").coalesce(1).write.mode("append").parquet(f"{landing}/trips_2024-01.parquet")
    land(df, landing, "2024-02")
    follow_landing(spark, landing, lake).awaitTermination()
    elt.backfill(spark, landing, other, Months.between("2024-01", "2024-02"), AS_OF)
    assert same_rows(stored(spark, other.gold), stored(spark, lake.gold))
    assert stored(spark, lake.gold).agg(F.sum("row_count")).first()[0] == 12


def test_writes_without_a_shuffle_read_small_splits(spark, tmp_path):
    key = "spark.sql.files.maxPartitionBytes"
    months_of_trips(spark, "2024-01", "2024-02", "2024-03").withColumn("year", F.lit(2024)).withColumn(
        "month", F.month("tpep_pickup_datetime")
    ).coalesce(1).write.parquet(f"{tmp_path}/in")
    before, seen = spark.conf.get(key), []

    class Seen:
        def __call__(self, writer, path, *args, **kwargs):
            seen.append(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
            return plain(writer, path, *args, **kwargs)

    from pyspark.sql import DataFrameWriter

    plain, seen_by = DataFrameWriter.parquet, Seen()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: seen_by(self, path, *a, **k))
        overwrite_partitions(spark.read.parquet(f"{tmp_path}/in"), f"{tmp_path}/out")
    assert seen[0] <= 32 << 20 and spark.conf.get(key) == before
    assert read_table(spark, f"{tmp_path}/out").groupBy("month").count().count() == 3


def test_sessions_with_smaller_splits_keep_them(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        with small_scans(spark):
            assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)


def test_landed_names_are_those_of_the_date_pattern(spark):
    days = ["1998-03-01 00:00:00", "1000-01-31 12:00:00", "9999-12-31 23:59:59", "0987-06-05 01:02:03", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").try_cast("timestamp_ntz").alias("t"))
    want = F.concat(F.date_format("t", "yyyy-MM"), F.lit(".parquet"))
    assert df.where(~month_file(F.col("t")).eqNullSafe(want)).isEmpty()
