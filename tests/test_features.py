import pytest
from helpers import plan_of, same_rows
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tripmart.config import CLASSIFICATION_FEATURES, REGRESSION_FEATURES, Months, ZONE_LABELS, ZoneLabel
from tripmart.functions.keys import bucket
from tripmart.operators import features, metrics, models, windows

MARCH = Months.of(1998, 3)


def test_month_arithmetic():
    assert Months.of(2024, 1).before(6) == Months.between("2023-07", "2023-12")
    assert Months.of(2024, 12).stop_day == "2025-01-01"
    assert Months.between("2023-11", "2024-02").pairs == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]


def test_training_window_ends_before_the_run_month(silver_table):
    ends = windows.training_window(silver_table, MARCH, 6).agg(
        F.min("tpep_pickup_datetime").alias("a"), F.max("tpep_pickup_datetime").alias("b")
    ).first()
    assert str(ends.a) >= "1997-09-01" and str(ends.b) < "1998-03-01"


def test_windows_prune_partitions(spark, silver_table, tmp_path):
    path = str(tmp_path / "silver")
    silver_table.write.partitionBy("year", "month").parquet(path)
    text = plan_of(windows.training_window(spark.read.parquet(path), MARCH, 6))
    line = next(x for x in text.splitlines() if "PartitionFilters" in x)
    assert "year" in line and "month" in line and "23972" in line
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in text


@pytest.mark.parametrize("parts", [1, 7])
def test_split_does_not_depend_on_partitioning(silver_table, parts):
    columns = ("tpep_pickup_datetime", "PULocationID", "total_amount")
    keyed = silver_table.withColumn("k", bucket(columns))
    train, test = windows.holdout_split(keyed, F.col("k"))
    again, _ = windows.holdout_split(
        silver_table.repartition(parts).withColumn("k", bucket(columns)), F.col("k")
    )
    assert train.count() + test.count() == silver_table.count()
    assert same_rows(train.select("trip_key", "k"), again.select("trip_key", "k"))
    share = train.count() / silver_table.count()
    assert 0.77 < share < 0.83


def test_sample_and_split_are_independent(silver_table):
    columns = ("tpep_pickup_datetime", "PULocationID", "total_amount")
    part = windows.key_sample(silver_table, bucket(columns, purpose="sample"), 30)
    train, test = windows.holdout_split(part.withColumn("k", bucket(columns)), F.col("k"))
    assert 0.27 < part.count() / silver_table.count() < 0.33
    assert 0.77 < train.count() / part.count() < 0.83 and not test.isEmpty()


@pytest.mark.parametrize(
    "tip, fare, label",
    [
        ("2.01", "10.00", "Alta"),
        ("2.00", "10.00", "Media"),
        ("0.50", "10.00", "Media"),
        ("0.49", "10.00", "Baja"),
        ("0.07", "0.35", "Media"),
        (None, "10.00", "Baja"),
    ],
)
def test_tip_label_bounds_are_exact(spark, tip, fare, label):
    df = spark.createDataFrame([(tip, fare)], "tip string, fare string").select(
        F.col("tip").cast("decimal(10,2)"), F.col("fare").cast("decimal(10,2)")
    )
    assert df.select(features.tip_label(F.col("tip"), F.col("fare")).alias("x")).first().x == label


def test_feature_rows_with_nulls_drop_out(silver_table):
    with_null = silver_table.where("passenger_count IS NULL").count()
    assert with_null > 0
    for frame in (features.fare_features(silver_table), features.tip_features(silver_table)):
        assert frame.count() == silver_table.count() - with_null


def test_assembler_skips_nothing_more(silver_table):
    frame = features.fare_features(silver_table)
    stages = features.scaled_stages(REGRESSION_FEATURES, centred=False)
    assert Pipeline(stages=stages).fit(frame).transform(frame).count() == frame.count()


def test_labels_are_indexed_by_falling_frequency(silver_table):
    frame = features.tip_features(silver_table)
    model = Pipeline(stages=features.tip_stages(CLASSIFICATION_FEATURES)).fit(frame)
    rows = features.label_table(model, frame).orderBy("label").collect()
    counts = [r.row_count for r in rows]
    assert [r.label for r in rows] == [0.0, 1.0, 2.0] and counts == sorted(counts, reverse=True)


def test_f1_differs_from_accuracy_and_is_right(spark):
    pairs = [("a", "a")] * 6 + [("a", "b")] * 2 + [("b", "b")] * 1 + [("b", "c")] * 1
    df = spark.createDataFrame(pairs, "y string, p string")
    row = metrics.classification_scores(metrics.confusion(df, "y", "p")).first()
    assert row.accuracy == pytest.approx(0.7)
    f1_a, f1_b = 12 / 14, 2 / 5
    assert row.weighted_f1 == pytest.approx((f1_a * 8 + f1_b * 2) / 10)


def test_scores_without_rows_are_null(spark):
    df = spark.createDataFrame([], "y string, p string")
    row = metrics.classification_scores(metrics.confusion(df, "y", "p")).first()
    assert row.accuracy is None and row.weighted_f1 is None


def test_cluster_rules_apply_in_order(spark):
    rows = [
        (1, 0, 30.0, 9.0, 1.0, 20.0, 9000.0),
        (2, 1, 10.0, 2.0, 1.0, 20.0, 9000.0),
        (3, 2, 10.0, 4.0, 1.0, 20.0, 9000.0),
        (4, 3, 10.0, 4.0, 1.0, 1.0, 10.0),
        (5, 3, 20.0, 5.0, 1.0, 1.0, 10.0),
    ]
    df = spark.createDataFrame(
        rows,
        "PULocationID int, cluster int, avg_revenue double, avg_distance double,"
        " avg_duration_minutes double, avg_tip_efficiency double, total_trips double",
    )
    out = {r.PULocationID: r.cluster_label for r in models.label_zones(df).collect()}
    assert out == {
        1: "Premium Zone", 2: "High Frequency Zone", 3: "High Tip Zone",
        4: "Standard Zone", 5: "Standard Zone",
    }
    strict = models.label_zones(df, (ZoneLabel("Premium Zone", {"avg_revenue": (50, None)}), *ZONE_LABELS[1:])).where("cluster = 0")
    assert strict.first().cluster_label == "High Tip Zone"


def test_only_the_label_side_is_broadcast(spark):
    df = spark.range(10).selectExpr(
        "cast(id as int) PULocationID", "cast(id % 4 as int) cluster", "1D avg_revenue",
        "1D avg_distance", "1D avg_duration_minutes", "1D avg_tip_efficiency", "1D total_trips",
    )
    assert "BroadcastHashJoin LeftOuter BuildRight" in plan_of(models.label_zones(df))


def test_vector_parts(spark, silver_table):
    frame = features.fare_features(silver_table).limit(5)
    stages = features.scaled_stages(REGRESSION_FEATURES, centred=False)
    scaled = Pipeline(stages=stages).fit(frame).transform(frame)
    flat = features.vector_columns(scaled, "features", REGRESSION_FEATURES, "f_")
    row = flat.select("f_trip_distance", vector_to_array("features")[0].alias("x")).first()
    assert row.f_trip_distance == row.x
