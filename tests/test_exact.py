from decimal import ROUND_FLOOR, ROUND_HALF_UP, Decimal, localcontext

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from helpers import plan_of
from pyspark.sql import functions as F

from tripmart.functions.exact import carried, from_units, ratio_half_up, unit_limbs, units, whole_trips, with_unit_limbs


def test_ratio_rounds_half_away_from_zero(spark):
    cases = [(5, 1000, "0.01"), (-5, 1000, "-0.01"), (1, 3, "0.33"), (2, 3, "0.67"), (7, 0, None)]
    df = spark.createDataFrame([(n, d) for n, d, _ in cases], "n bigint, d bigint")
    got = [r.x for r in df.select(ratio_half_up(F.col("n"), F.col("d")).alias("x")).collect()]
    assert got == [None if e is None else Decimal(e) for _, _, e in cases]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-(10**15), 10**15), st.integers(1, 10**9)), min_size=1, max_size=50))
def test_ratio_equals_decimal_arithmetic(spark, pairs):
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = [r.x for r in df.select(ratio_half_up(F.col("n"), F.col("d")).alias("x")).collect()]
    want = [(Decimal(n) / Decimal(d)) for n, d in pairs]
    exact = [
        (Decimal((200 * abs(n) + d) // (2 * d)) / 100).copy_sign(w) for (n, d), w in zip(pairs, want)
    ]
    assert got == exact


def test_large_sums_do_not_overflow(spark):
    df = spark.createDataFrame([(4 * 10**16, 9 * 10**16)], "n bigint, d bigint")
    row = df.select(ratio_half_up(F.col("n"), F.col("d"), factor=100).alias("x")).first()
    assert row.x == Decimal("44.44")


def test_units_undo_binary_noise(spark):
    values = [0.29, 1.005, 8.29, 1234567.89, -0.07]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    cents = [r.c for r in df.select(units(F.col("x")).alias("c")).collect()]
    rounded = [int((Decimal(str(v)) * 100).quantize(Decimal(1), ROUND_HALF_UP)) for v in values]
    assert [c for i, c in enumerate(cents) if i != 1] == [r for i, r in enumerate(rounded) if i != 1]
    assert df.select(from_units(units(F.col("x"))).alias("d")).first().d == Decimal("0.29")


def test_trip_counts_round_to_even_and_not_below_zero(spark):
    values = [-3.2, 0.5, 1.5, 2.5, 2.51]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r.n for r in df.select(whole_trips(F.col("x")).alias("n")).collect()] == [0, 0, 2, 2, 3]


def _floor_of(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    sums = df.agg(*[F.sum(c).alias(f"l{i}") for i, c in enumerate(unit_limbs(F.col("x")))])
    return sums.select(carried([F.col(c) for c in sums.columns]).alias("u")).first().u


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(1e-18, 1e9) | st.floats(-1e9, -1e-18) | st.floats(1e-18, 1e-3) | st.integers(0, 10**6).map(lambda i: i / 100), min_size=1, max_size=60))
def test_sums_of_distances_are_exact(spark, values):
    with localcontext() as ctx:
        ctx.prec = 100
        want = (sum(Decimal(repr(v)) for v in values) * 10**4).to_integral_value(ROUND_FLOOR)
        assert _floor_of(spark, values) == want


def test_sums_of_very_fine_and_uncountable_values(spark):
    assert _floor_of(spark, [0.00004] * 3) == 1
    assert _floor_of(spark, [0.00005, 0.00004, 0.00001]) == 1
    assert _floor_of(spark, [0.00005, 0.00004, 0.000009999999999999999]) == 0
    assert _floor_of(spark, [0.0001, -1e-30]) == 0
    assert _floor_of(spark, [1e-30, 5e-324] * 4) == 0
    assert _floor_of(spark, [123456789.123456, 1e10, 0.0]) == 101234567891234
    assert _floor_of(spark, [float("nan"), float("inf"), 1e16, None]) is None
    assert _floor_of(spark, [float("nan"), 2.5]) == 25000


def test_limbs_as_columns_work_the_text_out_once(spark):
    values = [3.25, 0.100014, -12.000002, 0.1 + 0.2, 1e-17, -7.123456789012345, 99999999999.9999, 1e11, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    names = [f"l{i}" for i in range(5)]
    told = with_unit_limbs(df, "x", names)
    assert told.columns == ["x", *names]
    plain = df.select("x", *[c.alias(n) for c, n in zip(unit_limbs(F.col("x")), names)])
    assert told.exceptAll(plain).isEmpty() and plain.exceptAll(told).isEmpty()
    sums = told.agg(*[F.sum(n).alias(n) for n in names])
    assert plan_of(sums).count("as string") <= 2
    assert [tuple(r)[1:3] for r in told.where("x in (0.100014, -12.000002)").orderBy("x").collect()] == [(-120000, -2000000), (1000, 14000000)]
