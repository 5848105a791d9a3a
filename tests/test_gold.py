from decimal import Decimal

from helpers import day, plan_of, raw_trips, same_rows
from pyspark.sql import functions as F

from tripmart.config import Months
from tripmart.operators import gold, serving, silver

JANUARY = Months.of(2024, 1)


def mart(df):
    return gold.zone_day(silver.clean(df, JANUARY))


def test_metrics_of_a_zone_day(spark):
    df = raw_trips(
        spark,
        {},
        {"VendorID": None, "trip_distance": 1.0, "passenger_count": None},
        {"payment_type": 2, "total_amount": 15.0, "fare_amount": 10.0},
        {"total_amount": 18.0, "tpep_dropoff_datetime": None},
    )
    row = mart(df).first()
    assert row.pickup_date == day("2024-01-15") and row.PULocationID == 10
    assert row.row_count == 4 and row.total_trips == 3
    assert row.flagged_incorrect_trips == 1
    assert row.total_revenue == Decimal("67.00")
    assert row.avg_revenue == Decimal("16.75")
    assert row.total_tips_profit == Decimal("6.00")
    assert row.tip_efficiency_pct == 15.0
    assert row.avg_distance == 2.88  # 11.5 / 4 = 2.875, half up
    assert row.total_passengers_transported == 6
    assert row.avg_duration_minutes == 15.5
    assert row.data_trust_score == 66.67
    assert (row.year, row.month) == (2024, 1)


def test_trust_is_null_without_vendors_and_may_be_negative(spark):
    wrong = {"total_amount": 1.0}
    no_vendor = mart(raw_trips(spark, {"VendorID": None})).first()
    assert no_vendor.data_trust_score is None and no_vendor.total_trips == 0
    mixed = mart(raw_trips(spark, wrong, {"VendorID": None, **wrong})).first()
    assert mixed.data_trust_score == -100.0


def test_tip_efficiency_is_zero_without_fares(spark):
    cents = spark.createDataFrame([(500, 0), (500, -3), (500, 1000)], "tip bigint, fare bigint")
    got = cents.select(gold.tip_efficiency(F.col("tip"), F.col("fare")).cast("double").alias("x"))
    assert [r.x for r in got.collect()] == [0.0, 0.0, 50.0]


def test_passengers_all_null_is_null(spark):
    assert mart(raw_trips(spark, {"passenger_count": None})).first().total_passengers_transported is None


def test_partitioning_does_not_change_the_mart(spark, silver_table, gold_table):
    shuffled = gold.zone_day(silver_table.repartition(13, "total_amount"))
    assert same_rows(gold_table, shuffled)


def test_fine_distances_are_not_rounded_one_by_one(spark):
    assert mart(raw_trips(spark, *[{"trip_distance": 0.00004}] * 3)).first().avg_distance == 0.0
    ties = [{"trip_distance": d} for d in (0.00499, 0.00501, 0.005)]  # each alone, rounded first, would differ
    assert mart(raw_trips(spark, *ties)).first().avg_distance == 0.01
    below = [{"trip_distance": d} for d in (0.00499, 0.005, 0.005, 0.005000000001)]
    assert mart(raw_trips(spark, *below)).first().avg_distance == 0.0


def test_rollup_grains_agree(spark, gold_table):
    rows = gold.rollup(gold_table)
    totals = {
        r.grain: (r.trips, r.revenue)
        for r in rows.groupBy("grain")
        .agg(F.sum("total_trips").alias("trips"), F.sum("total_revenue").alias("revenue"))
        .collect()
    }
    assert set(totals) == {"month_zone", "month", "zone", "total"}
    assert len(set(totals.values())) == 1


def test_aggregation_is_partial_before_the_shuffle(spark, silver_table):
    text = plan_of(gold.zone_day(silver_table))
    assert "partial_sum" in text and text.count("Exchange") <= 3
    assert "SortAggregate" not in text


def test_month_without_data_gives_zeros(spark, gold_table):
    row = serving.monthly_kpis(gold_table, 1980, 5).first()
    assert row.asDict() == {
        "year": 1980, "month": 5, "total_revenue": 0.0, "total_trips": 0,
        "avg_tip": 0.0, "data_trust_score": 0.0,
    }
