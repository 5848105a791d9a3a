from helpers import plan_of
from pyspark.sql import functions as F

from tripmart.config import Months
from tripmart.operators import serving

MARCH = Months.of(1998, 3)


def mart_rows(spark, *zones):
    """(zone, revenue) rows of one month."""
    rows = [(z, r, 2024, 1, 1, 0, "1.00") for z, r in zones]
    return spark.createDataFrame(
        rows,
        "PULocationID int, total_revenue string, year int, month int, total_trips bigint,"
        " flagged_incorrect_trips bigint, total_tips_profit string",
    ).withColumns(
        {c: F.col(c).cast("decimal(20,2)") for c in ("total_revenue", "total_tips_profit")}
    )


def test_top_zones_break_ties_by_zone(spark):
    df = mart_rows(spark, (7, "5.00"), (3, "5.00"), (9, "8.00"), (9, "1.00"), (1, "2.00"))
    rows = serving.top_zones(df, Months.of(2024, 1), 3).collect()
    assert [(r.pu_location_id, r.total_revenue) for r in rows] == [(9, 9.0), (3, 5.0), (7, 5.0)]


def test_top_zones_need_no_full_sort(gold_table):
    assert "TakeOrderedAndProject" in plan_of(serving.top_zones(gold_table, MARCH))


def test_month_rows_equal_the_month_query(gold_table):
    one = serving.monthly_kpis(gold_table, 1998, 3).first()
    same = serving.kpis_by_month(gold_table).where("year = 1998 AND month = 3").first()
    assert one.asDict() == same.asDict()


def predictions(spark, *pairs):
    rows = [(f"2024-01-{d:02d} 12:00:00", a, p) for d, a, p in pairs]
    df = spark.createDataFrame(rows, "t string, total_amount double, predicted_total_amount double")
    return df.select(F.col("t").cast("timestamp").alias("tpep_pickup_datetime"), "*").drop("t")


def test_accuracy_counts_an_error_of_exactly_two(spark):
    df = predictions(spark, (1, 31.1, 33.1), (1, 10.0, 12.01), (2, 10.0, 8.0))
    assert serving.fare_accuracy(df).first().accuracy_pct == 66.67
    assert serving.fare_accuracy(df.limit(0)).first().accuracy_pct == 0.0


def test_daily_comparison_nested_and_flat(spark):
    df = predictions(spark, (2, 10.0, 11.0), (1, 1.0, 2.0), (1, 2.0, 2.01))
    flat = serving.daily_fares(df).orderBy("day").collect()
    assert [(r.day, r.avg_real, r.avg_predicted) for r in flat] == [(1, 1.5, 2.01), (2, 10.0, 11.0)]
    row = serving.fare_report(df, 2024, 1).first()
    assert [tuple(d) for d in row.daily_comparison] == [tuple(r) for r in flat]
    assert row.accuracy_pct == 100.0


def test_tip_shares_are_of_the_actual_label(spark):
    df = spark.createDataFrame(
        [("Alta", "Baja"), ("Alta", "Alta"), ("Media", "Baja")], "tip_label string, predicted_tip_label string"
    )
    row = serving.tip_distribution(df, 2024, 1).first()
    assert (row.high_pct, row.medium_pct, row.low_pct) == (66.67, 33.33, 0.0)
    assert (row.predicted_high_pct, row.predicted_low_pct) == (33.33, 66.67)
    empty = serving.tip_distribution(df.select("tip_label").limit(0), 2024, 1).first()
    assert (empty.high_pct, empty.medium_pct, empty.low_pct) == (0.0, 0.0, 0.0)
    assert "predicted_high_pct" not in empty.asDict()
