from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from helpers import by_id, plan_of, raw_trips, same_rows
from pyspark.sql import functions as F

from tripmart.config import Months, TripContract
from tripmart.operators import silver

JANUARY = Months.of(2024, 1)
STAMP = "timestamp'2024-05-01'"


def clean(df, months=JANUARY, **kw):
    return silver.clean(df, months, processed_at=F.expr(STAMP), **kw)


def test_ids_become_int_or_null(spark):
    df = raw_trips(spark, {}, {"VendorID": None}, {"VendorID": float("nan")})
    out = by_id(silver.repair(df))
    assert [out[i].VendorID for i in range(3)] == [1, None, None]
    assert dict(silver.repair(df).dtypes)["RatecodeID"] == "int"


def test_times_that_are_no_times_become_null(spark):
    df = raw_trips(spark, {}, {"tpep_dropoff_datetime": "soon"}, times="string")
    out = by_id(silver.repair(df))
    assert out[0].tpep_dropoff_datetime is not None
    assert out[1].tpep_dropoff_datetime is None
    assert by_id(clean(df))[1].trip_duration_minutes is None


def test_flag_null_is_false(spark):
    flags = ["Y", "N", None, "x"]
    df = raw_trips(spark, *[{"store_and_fwd_flag": f} for f in flags])
    out = by_id(silver.repair(df))
    assert [out[i].store_and_fwd_flag for i in range(4)] == [True, False, False, False]


def test_zero_passengers_become_one_and_null_stays(spark):
    df = raw_trips(spark, *[{"passenger_count": p} for p in (0.0, None, 3.0)])
    out = by_id(silver.repair(df))
    assert [out[i].passenger_count for i in range(3)] == [1, None, 3]


def test_money_null_is_zero_and_half_cents_round_up(spark):
    cases = [
        (None, "0.00"), (0.005, "0.01"), (1.005, "1.01"), (-0.015, "-0.02"), (12.344999, "12.34"),
        (99999999.99, "99999999.99"), (1e8, None), (-1e9, None), (1e300, None),
        (float("nan"), None), (float("inf"), None),
    ]
    df = raw_trips(spark, *[{"extra": v} for v, _ in cases])
    out = by_id(silver.repair(df))
    got = [out[i].extra for i in range(len(cases))]
    assert got == [None if w is None else Decimal(w) for _, w in cases]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-2e8, 2e8) | st.integers(-10**7, 10**7).map(lambda n: n / 1000), max_size=80))
def test_money_equals_the_plain_cast(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    cast = F.col("x").try_cast("decimal(10,2)")
    assert df.where(~silver.money("x").eqNullSafe(cast)).isEmpty()


@pytest.mark.parametrize(
    "change, kept",
    [
        ({}, True),
        ({"trip_distance": 0.0}, False),
        ({"trip_distance": -1.0}, False),
        ({"trip_distance": None}, False),
        ({"RatecodeID": 6.0}, True),
        ({"RatecodeID": 6.9}, True),
        ({"RatecodeID": 7.0}, False),
        ({"RatecodeID": 0.5}, False),
        ({"RatecodeID": 99.0}, False),
        ({"RatecodeID": None}, False),
        ({"fare_amount": 0.0}, False),
        ({"fare_amount": 0.004}, False),
        ({"fare_amount": 0.005}, True),
        ({"fare_amount": None}, False),
        ({"fare_amount": -5.0}, False),
        ({"tpep_pickup_datetime": "2024-02-01 00:00:00"}, False),
        ({"tpep_pickup_datetime": "2024-01-31 23:59:59"}, True),
        ({"tpep_pickup_datetime": "2023-12-31 23:59:59"}, False),
        ({"tpep_pickup_datetime": None}, False),
        ({"tpep_dropoff_datetime": "2024-01-15 08:00:00"}, True),
    ],
)
@pytest.mark.parametrize("times", ["timestamp_ntz", "string"])
def test_row_rules(spark, change, kept, times):
    assert clean(raw_trips(spark, change, times=times)).count() == int(kept)


def test_tip_counts_for_cards_only_before_the_total_check(spark):
    df = raw_trips(
        spark,
        {},
        {"payment_type": 2},
        {"payment_type": None},
        {"payment_type": 2, "total_amount": 15.0},
    )
    out = by_id(clean(df))
    assert [out[i].tip_amount for i in range(4)] == [Decimal("2.00")] + [Decimal("0.00")] * 3
    assert [out[i].is_total_correct for i in range(4)] == [True, False, False, True]
    assert out[1].calculated_total == Decimal("15.00")
    assert dict(clean(df).dtypes)["tip_amount"] == "decimal(10,2)"


def test_duration_in_minutes_may_be_negative(spark):
    df = raw_trips(spark, {}, {"tpep_dropoff_datetime": "2024-01-15 08:29:00"})
    out = by_id(clean(df))
    assert out[0].trip_duration_minutes == 15.5
    assert out[1].trip_duration_minutes == -1.0


def test_component_list_is_configuration(spark):
    df = raw_trips(spark, {"total_amount": 17.75}).withColumn("cbd_fee", F.lit(0.75))
    assert not clean(df).first().is_total_correct
    wide = TripContract(
        columns=TripContract().columns | {"cbd_fee": "double"},
        money=TripContract().money + ("cbd_fee",),
        components=TripContract().components + ("cbd_fee",),
    )
    row = clean(df, contract=wide).first()
    assert row.is_total_correct and row.cbd_fee == Decimal("0.75")


def test_extra_columns_pass_through(spark):
    df = raw_trips(spark, {}).withColumn("note", F.lit("kept"))
    assert clean(df).first().note == "kept"


def test_file_month_drops_strays(spark):
    df = raw_trips(spark, {}, {"tpep_pickup_datetime": "2024-02-10 10:00:00"}, {})
    keyed = df.withColumns({"year": F.lit(2024), "month": F.when(F.col("id") == 2, 3).otherwise(1)})
    kept = clean(keyed, Months.between("2024-01", "2024-12"))
    assert [r.id for r in kept.collect()] == [0]


def test_cleaning_twice_changes_no_money(spark):
    once = clean(raw_trips(spark, {}, {"payment_type": 2}, {"extra": None})).drop("year", "month")
    money = ["id", *TripContract().money]
    again = clean(once.drop("store_and_fwd_flag").withColumn("store_and_fwd_flag", F.lit("N")))
    assert same_rows(once.select(*money), again.select(*money))


def test_audit_counts_every_failed_rule(spark):
    df = raw_trips(
        spark,
        {},
        {"trip_distance": 0.0, "fare_amount": -1.0},
        {"RatecodeID": 99.0},
        {"tpep_pickup_datetime": "2024-03-01 00:00:00"},
        {"tpep_dropoff_datetime": "2024-01-15 08:30:00"},
    )
    got = {r.rule: r.row_count for r in silver.reject_audit(df, JANUARY).collect()}
    assert got == {
        "distance_positive": 1,
        "distance_finite": 0,
        "rate_code_known": 1,
        "fare_positive": 1,
        "pickup_in_month": 1,
        # The pickup moved to March lies after its dropoff as well.
        "duration_positive": 2,
        "kept_rows": 2,
        "all_rows": 5,
    }
    assert clean(df).count() == got["kept_rows"]


def test_filters_reach_the_scan_and_nothing_is_shuffled(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_trips(spark, {}, {}).write.parquet(path)
    text = plan_of(clean(spark.read.parquet(path)).select("total_amount"))
    assert "Exchange" not in text and "Python" not in text
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    for test in (
        "GreaterThan(trip_distance,0.0)",
        "GreaterThan(fare_amount,0.0)",
        "LessThan(RatecodeID,7.0)",
        "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-01",
    ):
        assert test in pushed
    schema = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "tolls_amount" not in schema
