"""Fitted models held against what their fit must satisfy, and reports on a stored lake."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.catalog import reports as given
from tripmart.catalog.common import (
    HISTORY,
    MONTH,
    RUN_MONTH,
    WINDOW,
    YEAR,
    big,
    half_up,
    sample_gold,
    sample_lake,
    sample_landing,
    sample_silver,
    with_tables,
)
from tripmart.catalog.demand import CITY_SQL, HORIZON, SHAPE
from tripmart.catalog.features import CLUSTERS_SQL, SAMPLE_LABELS, given_clusters, given_fares, given_tips
from tripmart.catalog.runs import AS_OF
from tripmart.config import ModelConfig, Months, Run
from tripmart.operators import clusters, features, forecast, forests, models, windows
from tripmart.plans import elt
from tripmart.plans import models as training
from tripmart.plans.month import run_full_month
from tripmart.plans.reports import Reports
from tripmart.session import materialise
from tripmart.sources.lake import Lake, overwrite_partitions, overwrite_run, read_table, warn_if_empty

CFG = ModelConfig()
# Every tree sees all rows, so the value of a leaf is the mean of the rows that reach it.
WHOLE = ModelConfig(trees=3, subsample=1.0, bootstrap=False)
ORIGINS = 4
KEYS = ["PULocationID"]


# -- forests ----------------------------------------------------------------


def _fares(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    silver = materialise(sample_silver(spark, sf_dir), "silver")
    past = features.fare_features(windows.training_window(silver, RUN_MONTH, WINDOW), CFG)
    return past, features.fare_features(windows.prediction_window(silver, RUN_MONTH), CFG)


def fare_forest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip of the month scored from the node table as by the fitted forest."""
    past, now = _fares(spark, sf_dir)
    model = models.fit_fares(past, CFG)
    forest = model.stages[-1]
    nodes = materialise(forests.node_table(spark, forest), "nodes")
    placed = forests.with_leaves(model.transform(now), nodes, models.vector_to_array("features"), CFG.depth)
    gap = F.abs(forests.mean_of_leaves(F.col("leaves")) - F.col("prediction"))
    return placed.agg(
        F.count("*").alias("row_count"),
        F.max(F.size("leaves")).alias("trees"),
        F.bool_and(gap <= 1e-9 * F.greatest(F.abs("prediction"), F.lit(1.0))).alias("equal"),
    )


def fare_forest_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per tree grown on all rows: rows over its leaves, and each leaf the mean of the rows that reach it."""
    past, _ = _fares(spark, sf_dir)
    model = models.fit_fares(past, WHOLE)
    nodes = materialise(forests.node_table(spark, model.stages[-1]), "nodes")
    placed = forests.with_leaves(model.transform(past), nodes, models.vector_to_array("features"), WHOLE.depth)
    means = forests.leaf_means(placed, F.col("total_amount"))
    leaves = nodes.where("left < 0").join(means, ["tree", "node"], "left")
    near = F.abs(F.col("value") - F.col("mean")) <= 1e-9 * F.greatest(F.abs("mean"), F.lit(1.0))
    return leaves.groupBy("tree").agg(
        F.sum("n").alias("row_count"),
        F.bool_and(F.coalesce(near & (F.col("rows") == F.col("n")), F.lit(False))).alias("means"),
    )


def tip_forest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and confidence of every trip of the month from the node table as by the fitted forest."""
    silver = materialise(sample_silver(spark, sf_dir), "silver")
    past = features.tip_features(windows.training_window(silver, RUN_MONTH, WINDOW), CFG)
    now = features.tip_features(windows.prediction_window(silver, RUN_MONTH), CFG)
    model = models.fit_tips(past, CFG)
    _, vector, forest, _ = model.stages
    nodes = materialise(forests.node_table(spark, forest), "nodes")
    scored = forest.transform(vector.transform(now))
    placed = forests.with_leaves(scored, nodes, models.vector_to_array("features"), CFG.depth)
    placed = placed.withColumns({
        "shares": forests.class_shares(F.col("leaves"), forest.numClasses),
        "given": models.vector_to_array("probability"),
    })
    gaps = F.zip_with("shares", "given", lambda a, b: F.abs(a - b))
    best = F.get(F.col("shares"), F.col("prediction").cast("int")) >= F.array_max("shares") - 1e-9
    return placed.groupBy("tip_label").agg(
        F.count("*").alias("row_count"),
        F.bool_and(F.array_max(gaps) <= 1e-9).alias("equal"),
        F.bool_and(best).alias("largest"),
    )


# -- clusters ---------------------------------------------------------------


def zone_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clustering is at rest, and its silhouette from sums per cluster equals the evaluator's."""
    profile = materialise(features.zone_profile(sample_gold(spark, sf_dir)), "profile")
    model = models.fit_zones(profile, CFG)
    width = len(CFG.zone_features)
    placed = model.transform(profile).select("PULocationID", "cluster", models.vector_to_array("features").alias("x"))
    value = models.silhouette(model, profile)
    scores = clusters.silhouettes(placed, "x", "cluster", width).agg(
        F.count("*").alias("zones"), (F.abs(F.avg("silhouette") - value) <= 1e-9).alias("silhouette_equal")
    )
    rest = clusters.fixed_point(placed, "x", "cluster", model.stages[-1].clusterCenters()).agg(
        F.count("*").alias("clusters"), F.bool_and("centred").alias("centred"), F.bool_and("nearest").alias("nearest")
    )
    one = F.lit(1).alias("one")
    return scores.select("*", one).join(rest.select("*", one), "one").drop("one")


# -- forecast ---------------------------------------------------------------


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(features.daily_demand(sample_gold(spark, sf_dir), tuple(KEYS)), "zones")


def forecast_optimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every zone's fit solves its ridge equations, by residuals of all its days; so does its deviation."""
    series = _zones(spark, sf_dir)
    history = forecast.history_of(series)
    fitted = materialise(forecast.fit_many(series, KEYS, history, SHAPE), "fitted")
    checked = forecast.certificate(series, fitted, KEYS, history, SHAPE)
    return checked.select(
        *KEYS,
        "days",
        (F.col("gap") <= 1e-6).alias("optimal"),
        (F.abs(F.col("sigma") - F.col("sigma_rows")) <= 1e-6 * (1 + F.col("size"))).alias("sigma_equal"),
    )


def _tested(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = _zones(spark, sf_dir)
    history = forecast.history_of(series)
    origins = forecast.cut_offs(history, HORIZON, ORIGINS)
    return forecast.back_test(series, KEYS, history.first, origins, HORIZON, SHAPE)


def backtest_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per zone: share of actual days inside the band, error of forecast and of baseline, over four origins."""
    return forecast.back_test_scores(_tested(spark, sf_dir), KEYS)


def backtest_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sides of the back-test that need no fit: days, actual demand, error of the baseline."""
    tested = materialise(_tested(spark, sf_dir), "tested")
    scores = forecast.back_test_scores(tested, KEYS).select(*KEYS, "days", "mae_naive")
    return scores.join(tested.groupBy(*KEYS).agg(F.sum("y").alias("trips")), KEYS)


# -- reports on a stored lake -------------------------------------------------


def _lake(spark: SparkSession) -> tuple[Lake, Reports]:
    lake = sample_lake(spark)
    return lake, Reports(spark, lake)


def lake_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, read = _lake(spark)
    overwrite_partitions(sample_gold(spark, sf_dir), lake.gold, rebalance=True)
    return read.kpis_by_month()


def lake_top_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, read = _lake(spark)
    overwrite_partitions(sample_gold(spark, sf_dir), lake.gold, rebalance=True)
    return read.top_zones_by_revenue(YEAR, MONTH)


def _stored_fares(spark: SparkSession, sf_dir: str) -> Reports:
    """Predictions of the run month, and those of the month before in a run of their own."""
    lake, read = _lake(spark)
    silver = materialise(sample_silver(spark, sf_dir), "silver")
    for run in (RUN_MONTH, RUN_MONTH.before(1)):
        rows = given_fares(windows.prediction_window(silver, run))
        overwrite_run(rows, lake.fare_predictions, *run.pairs[0])
    return read


def lake_fare_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested report, its daily comparison laid out."""
    report = _stored_fares(spark, sf_dir).regression_metrics(YEAR, MONTH)
    return report.select("year", "month", "accuracy_pct", F.inline("daily_comparison"))


def lake_tip_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, read = _lake(spark)
    silver = materialise(sample_silver(spark, sf_dir), "silver")
    for run in (RUN_MONTH, RUN_MONTH.before(1)):
        rows = given_tips(windows.prediction_window(silver, run))
        overwrite_run(rows, lake.tip_predictions, *run.pairs[0])
    return read.tip_distribution(YEAR, MONTH)


def lake_zone_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of the newest of two runs."""
    lake, read = _lake(spark)
    labelled = models.label_zones(given_clusters(sample_gold(spark, sf_dir)), SAMPLE_LABELS)
    labelled = materialise(labelled, "labelled")
    overwrite_run(labelled, lake.clusters, YEAR, MONTH)
    overwrite_run(labelled.withColumn("cluster", F.lit(9)), lake.clusters, *RUN_MONTH.before(1).pairs[0])
    return read.zone_clusters()


def lake_zone_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested lists of zones by label, laid out."""
    lake, read = _lake(spark)
    labelled = models.label_zones(given_clusters(sample_gold(spark, sf_dir)), SAMPLE_LABELS)
    overwrite_run(labelled, lake.clusters, YEAR, MONTH)
    return read.zone_lists(YEAR, MONTH).select("cluster_label", F.inline("zones"))


def _stored_forecast(spark: SparkSession, sf_dir: str) -> Reports:
    lake, read = _lake(spark)
    overwrite_run(given._given_forecast(spark, sf_dir), lake.forecasts, YEAR, MONTH)
    return read


def lake_forecast_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History and forecast of the nested report, laid out."""
    report = materialise(_stored_forecast(spark, sf_dir).forecast(), "report")
    sides = [
        report.select(F.inline(part)).withColumn("part", F.lit(part)) for part in ("historical", "forecast")
    ]
    return sides[0].unionByName(sides[1])


def lake_peak_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peak days of the nested report, laid out."""
    return _stored_forecast(spark, sf_dir).forecast().select(F.inline("peak_days"))


# -- whole runs -------------------------------------------------------------


def _run_tables(spark: SparkSession, lake: Lake) -> DataFrame:
    """Runs and rows of every table that a monthly run of the models writes."""
    paths = {
        "fare_predictions": lake.fare_predictions, "tip_predictions": lake.tip_predictions,
        "zone_profiles": lake.zone_profiles, "clusters": lake.clusters, "forecasts": lake.forecasts,
        "zone_forecasts": lake.zone_forecasts, "metrics": lake.metrics,
    }
    counts = [
        read_table(spark, path).groupBy("run_year", "run_month").agg(F.count("*").alias("row_count"))
        .withColumn("name", F.lit(name))
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def ml_month_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run of all models leaves: one run per table, with the rows that the month asks for."""
    lake, _ = _lake(spark)
    overwrite_partitions(sample_silver(spark, sf_dir), lake.silver, rebalance=True)
    elt.build_gold(spark, lake, HISTORY.pairs)
    training.run_models(spark, lake, Run(YEAR, MONTH, AS_OF))
    return _run_tables(spark, lake)


def full_month_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after landing, loading and training in one call, over an earlier run of the month."""
    lake, _ = _lake(spark)
    landing = sample_landing(spark, sf_dir)
    elt.backfill(spark, landing, lake, HISTORY, AS_OF)
    overwrite_run(spark.range(3), lake.metrics, YEAR, MONTH)
    run_full_month(spark, landing, lake, Run(YEAR, MONTH, AS_OF))
    return _run_tables(spark, lake)


def empty_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of three months of a stored table the scan warns of as empty, and their rows."""
    lake, _ = _lake(spark)
    overwrite_partitions(sample_silver(spark, sf_dir), lake.silver, rebalance=True)
    parts = []
    for months in (RUN_MONTH, RUN_MONTH.before(1), Months.of(1990, 1)):
        (year, month), = months.pairs
        rows = read_table(spark, lake.silver, months)
        empty = warn_if_empty(rows, f"{year}-{month:02d}")
        parts.append(rows.agg(
            F.lit(year).alias("year"), F.lit(month).alias("month"), F.lit(empty).alias("warned"),
            F.count("*").alias("row_count"),
        ))
    return reduce(DataFrame.unionByName, parts)


QUERIES = {
    f.__name__: f
    for f in (
        fare_forest_table, fare_forest_leaves, tip_forest_table, zone_certificate, forecast_optimal, backtest_zones,
        backtest_baseline, lake_kpis, lake_top_zones, lake_fare_report, lake_tip_report, lake_zone_clusters,
        lake_zone_lists, lake_forecast_report, lake_peak_days, ml_month_tables, full_month_tables, empty_scan,
    )
}

_NOW = f"year = {YEAR} AND month = {MONTH}"
_PAST = RUN_MONTH.before(WINDOW)
_BEFORE = f"year * 12 + month - 1 >= {_PAST.first} AND year * 12 + month - 1 < {_PAST.stop}"
_TIP = "CASE WHEN tip_c * 100 > fare_c * 20 THEN 'Alta' WHEN tip_c * 100 >= fare_c * 5 THEN 'Media' ELSE 'Baja' END"
_ORIGINS = ", ".join(f"({HORIZON * i})" for i in range(1, ORIGINS + 1))

_WIDE = RUN_MONTH.widened(WINDOW)
_UNTIL = f"pickup_date < DATE '{RUN_MONTH.stop_day}'"
_RUN_TABLES = f"""SELECT {YEAR} AS run_year, {MONTH} AS run_month, name, row_count FROM (
 SELECT unnest(['fare_predictions', 'tip_predictions']) AS name,
  (SELECT COUNT(*) FROM silver WHERE {_NOW} AND passenger_count IS NOT NULL) AS row_count
 UNION ALL SELECT unnest(['zone_profiles', 'clusters']), (SELECT COUNT(DISTINCT PULocationID) FROM gold
  WHERE year * 12 + month - 1 >= {_WIDE.first} AND year * 12 + month - 1 < {_WIDE.stop})
 UNION ALL SELECT 'forecasts', MAX(pickup_date) - MIN(pickup_date) + 1 + {CFG.horizon_days} FROM gold WHERE {_UNTIL}
 UNION ALL SELECT 'zone_forecasts', COUNT(DISTINCT PULocationID)
  * (MAX(pickup_date) - MIN(pickup_date) + 1 + {CFG.horizon_days}) FROM gold WHERE {_UNTIL}
 UNION ALL SELECT 'metrics', 5)"""

ORACLE = {
    "ml_month_tables": with_tables("gold", _RUN_TABLES),
    "full_month_tables": with_tables("gold", _RUN_TABLES),
    "empty_scan": with_tables(
        "silver",
        f"""SELECT CAST(m // 12 AS INT) AS year, CAST(m % 12 + 1 AS INT) AS month, COUNT(s.m2) = 0 AS warned, COUNT(s.m2) AS row_count
 FROM (VALUES ({RUN_MONTH.first}), ({RUN_MONTH.first - 1}), ({1990 * 12})) w(m)
 LEFT JOIN (SELECT year * 12 + month - 1 AS m2 FROM silver) s ON s.m2 = w.m GROUP BY m""",
    ),
    "lake_zone_lists": with_tables(
        "gold",
        f"""SELECT cluster_label, PULocationID AS pu_location_id, cluster, {given._two("avg_revenue")} AS avg_revenue,
 {given._two("avg_distance")} AS avg_distance, {big("total_trips")} AS total_trips
 FROM clusters JOIN labels USING (cluster)""",
        CLUSTERS_SQL,
    ),
    "fare_forest_table": with_tables(
        "silver",
        f"""SELECT COUNT(*) AS row_count, {CFG.trees} AS trees, TRUE AS equal
 FROM silver WHERE {_NOW} AND passenger_count IS NOT NULL""",
    ),
    "fare_forest_leaves": with_tables(
        "silver",
        f"""SELECT CAST(unnest(generate_series(0, {WHOLE.trees - 1})) AS INT) AS tree, row_count, TRUE AS means
 FROM (SELECT COUNT(*) AS row_count FROM silver WHERE {_BEFORE} AND passenger_count IS NOT NULL)""",
    ),
    "tip_forest_table": with_tables(
        "silver",
        f"""SELECT {_TIP} AS tip_label, COUNT(*) AS row_count, TRUE AS equal, TRUE AS largest
 FROM silver WHERE {_NOW} AND passenger_count IS NOT NULL GROUP BY ALL""",
    ),
    "zone_certificate": with_tables(
        "gold",
        f"""SELECT COUNT(DISTINCT PULocationID) AS zones, TRUE AS silhouette_equal,
 CAST({CFG.clusters} AS BIGINT) AS clusters, TRUE AS centred, TRUE AS nearest FROM gold""",
    ),
    "forecast_optimal": with_tables(
        "gold",
        """SELECT DISTINCT PULocationID, CAST(hi - lo + 1 AS BIGINT) AS days, TRUE AS optimal, TRUE AS sigma_equal
 FROM gold, ends""",
        CITY_SQL,
    ),
    "backtest_baseline": with_tables(
        "gold",
        f"""SELECT PULocationID, COUNT(*) AS days, {half_up("SUM(ABS(4 * y - recent))", "COUNT(*) * 4")} AS mae_naive,
 {big("SUM(y)")} AS trips FROM tested GROUP BY PULocationID""",
        f"""{CITY_SQL},
zones AS (SELECT PULocationID, pickup_date AS ds, SUM(total_trips) AS y FROM gold GROUP BY ALL),
origins AS (SELECT CAST(hi - back AS DATE) AS origin FROM ends, (VALUES {_ORIGINS}) b(back)),
begun AS (SELECT z.PULocationID, o.origin FROM origins o, zones z WHERE z.ds <= o.origin GROUP BY ALL),
ahead AS (SELECT PULocationID, origin, CAST(unnest(generate_series(origin + 1, origin + {HORIZON}, INTERVAL 1 DAY)) AS DATE) AS ds FROM begun),
tested AS (SELECT a.PULocationID, a.origin, a.ds,
  COALESCE((SELECT SUM(y) FROM zones z WHERE z.PULocationID = a.PULocationID AND z.ds = a.ds), 0) AS y,
  COALESCE((SELECT SUM(y) FROM zones z WHERE z.PULocationID = a.PULocationID AND z.ds <= a.origin
   AND z.ds > a.origin - 28 AND dayofweek(z.ds) = dayofweek(a.ds)), 0) AS recent FROM ahead a)""",
    ),
    "lake_kpis": given.ORACLE["kpi_all_months"],
    "lake_top_zones": given.ORACLE["top_zones"],
    "lake_fare_report": with_tables(
        "silver",
        f"""SELECT {YEAR} AS year, {MONTH} AS month, CAST(day(tpep_pickup_datetime) AS INT) AS day,
 {half_up("SUM(total_c)", "COUNT(*) * 100")} AS avg_real,
 {half_up("SUM(fare_c + 500)", "COUNT(*) * 100")} AS avg_predicted,
 (SELECT {half_up("100 * COUNT(*) FILTER (WHERE ABS(total_c - fare_c - 500) <= 200)", "COUNT(*)")}
  FROM silver WHERE {_NOW}) AS accuracy_pct
 FROM silver WHERE {_NOW} GROUP BY 3""",
    ),
    "lake_tip_report": given.ORACLE["tip_distribution"],
    "lake_zone_clusters": given.ORACLE["zone_clusters_given"],
    "lake_forecast_report": given.ORACLE["forecast_split"],
    "lake_peak_days": given.ORACLE["peak_days"],
}
