"""Reporting queries, on the mart and on given predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.catalog.common import (
    MONTH,
    RUN_MONTH,
    YEAR,
    big,
    dollars,
    half_up,
    in_months,
    sample_gold,
    sample_silver,
    with_tables,
)
from tripmart.catalog.demand import CITY_SQL
from tripmart.catalog.features import (
    CLUSTERS_SQL,
    GUESS_SQL,
    LABEL_SQL,
    SAMPLE_LABELS,
    given_clusters,
    given_fares,
    given_tips,
)
from tripmart.operators import features, models, serving
from tripmart.session import materialise

EMPTY_YEAR, EMPTY_MONTH = 1990, 1


def kpi_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.monthly_kpis(sample_gold(spark, sf_dir), YEAR, MONTH)


def kpi_all_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.kpis_by_month(sample_gold(spark, sf_dir))


def kpi_empty_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.monthly_kpis(sample_gold(spark, sf_dir), EMPTY_YEAR, EMPTY_MONTH)


def top_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.top_zones(sample_gold(spark, sf_dir), RUN_MONTH)


def tip_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = given_tips(sample_silver(spark, sf_dir, RUN_MONTH))
    return serving.tip_distribution(table, YEAR, MONTH)


def reg_accuracy_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.fare_accuracy(given_fares(sample_silver(spark, sf_dir)))


def reg_daily_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.daily_fares(given_fares(sample_silver(spark, sf_dir, RUN_MONTH)))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.label_zones(given_clusters(sample_gold(spark, sf_dir)), SAMPLE_LABELS)


def zone_clusters_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.zone_clusters(_labelled(spark, sf_dir))


def clusters_by_label_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.zones_by_label(_labelled(spark, sf_dir))


def _given_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily demand as a forecast with a band of 5 trips."""
    city = features.daily_demand(sample_gold(spark, sf_dir))
    table = city.select(
        "ds",
        F.col("y").alias("yhat"),
        F.greatest(F.col("y") - 5, F.lit(0).cast("bigint")).alias("yhat_lower"),
        (F.col("y") + 5).alias("yhat_upper"),
    )
    return materialise(table, "forecast")


def forecast_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.forecast_parts(_given_forecast(spark, sf_dir))


def peak_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.peak_days(_given_forecast(spark, sf_dir))


def last_90_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.recent_history(_given_forecast(spark, sf_dir))


def combined_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.combined_series(_given_forecast(spark, sf_dir))


QUERIES = {
    "kpi_month": kpi_month,
    "kpi_all_months": kpi_all_months,
    "kpi_empty_month": kpi_empty_month,
    "top_zones": top_zones,
    "tip_distribution": tip_distribution,
    "reg_accuracy_given": reg_accuracy_given,
    "reg_daily_given": reg_daily_given,
    "zone_clusters_given": zone_clusters_given,
    "clusters_by_label_given": clusters_by_label_given,
    "forecast_split": forecast_split,
    "peak_days": peak_days,
    "last_90_days": last_90_days,
    "combined_series": combined_series,
}

_TRIPS, _TIPS, _FLAGGED = "SUM(total_trips)", "SUM(tips_c)", "SUM(flagged_incorrect_trips)"
_KPIS = f"""COALESCE({dollars("SUM(revenue_c)")}, 0.0) AS total_revenue,
 {big(f"COALESCE({_TRIPS}, 0)")} AS total_trips,
 COALESCE({half_up(_TIPS, f"{_TRIPS} * 100")}, 0.0) AS avg_tip,
 COALESCE({half_up(f"({_TRIPS} - {_FLAGGED}) * 100", _TRIPS)}, 0.0) AS data_trust_score"""


def _kpi(year: int, month: int) -> str:
    return f"""SELECT {year} AS year, {month} AS month, {_KPIS} FROM gold_cents
 WHERE year = {year} AND month = {month}"""


def _share(column: str, label: str) -> str:
    return half_up(f"100 * COUNT(*) FILTER (WHERE {column} = '{label}')", "COUNT(*)")


def _two(expr: str) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(18, 6)), 2) AS DOUBLE)"


_FORECAST = f"""{CITY_SQL},
forecast AS (SELECT ds, y AS yhat, {big("GREATEST(y - 5, 0)")} AS yhat_lower, y + 5 AS yhat_upper,
  CASE WHEN ds < hi - 29 THEN 'historical' ELSE 'forecast' END AS part FROM city, ends)"""
_RECENT = """SELECT ds, yhat, yhat_lower, yhat_upper FROM forecast
 WHERE part = 'historical' ORDER BY ds DESC LIMIT 90"""
_IN_MONTH = in_months("tpep_pickup_datetime", RUN_MONTH)

ORACLE = {
    "kpi_month": with_tables("gold_cents", _kpi(YEAR, MONTH)),
    "kpi_all_months": with_tables(
        "gold_cents", f"SELECT year, month, {_KPIS} FROM gold_cents GROUP BY year, month"
    ),
    "kpi_empty_month": with_tables("gold_cents", _kpi(EMPTY_YEAR, EMPTY_MONTH)),
    "top_zones": with_tables(
        "gold_cents",
        f"""SELECT PULocationID AS pu_location_id, {dollars("SUM(revenue_c)")} AS total_revenue
 FROM gold_cents WHERE year = {YEAR} AND month = {MONTH} GROUP BY PULocationID
 ORDER BY SUM(revenue_c) DESC, PULocationID LIMIT 10""",
    ),
    "tip_distribution": with_tables(
        "silver",
        f"""SELECT {YEAR} AS year, {MONTH} AS month,
 {_share("a", "Alta")} AS high_pct, {_share("a", "Media")} AS medium_pct, {_share("a", "Baja")} AS low_pct,
 {_share("p", "Alta")} AS predicted_high_pct, {_share("p", "Media")} AS predicted_medium_pct,
 {_share("p", "Baja")} AS predicted_low_pct
 FROM (SELECT {LABEL_SQL} AS a, {GUESS_SQL} AS p FROM silver WHERE {_IN_MONTH})""",
    ),
    "reg_accuracy_given": with_tables(
        "silver",
        f"""SELECT {half_up("100 * COUNT(*) FILTER (WHERE ABS(total_c - fare_c - 500) <= 200)", "COUNT(*)")}
 AS accuracy_pct FROM silver""",
    ),
    "reg_daily_given": with_tables(
        "silver",
        f"""SELECT CAST(day(tpep_pickup_datetime) AS INT) AS day,
 {half_up("SUM(total_c)", "COUNT(*) * 100")} AS avg_real,
 {half_up("SUM(fare_c + 500)", "COUNT(*) * 100")} AS avg_predicted
 FROM silver WHERE {_IN_MONTH} GROUP BY 1""",
    ),
    "zone_clusters_given": with_tables(
        "gold",
        f"""SELECT PULocationID AS pu_location_id, cluster, cluster_label,
 {_two("avg_revenue")} AS avg_revenue, {_two("avg_distance")} AS avg_distance,
 {_two("avg_duration_minutes")} AS avg_duration_minutes,
 {_two("avg_tip_efficiency")} AS avg_tip_efficiency, {big("total_trips")} AS total_trips
 FROM clusters JOIN labels USING (cluster)""",
        CLUSTERS_SQL,
    ),
    "clusters_by_label_given": with_tables(
        "gold",
        f"""SELECT cluster_label, {big("COUNT(*)")} AS zones, {_two("AVG(avg_revenue)")} AS avg_revenue,
 {_two("AVG(avg_distance)")} AS avg_distance
 FROM clusters JOIN labels USING (cluster) GROUP BY cluster_label""",
        CLUSTERS_SQL,
    ),
    "forecast_split": with_tables("gold", "SELECT * FROM forecast", _FORECAST),
    "peak_days": with_tables(
        "gold",
        """SELECT ds AS date, yhat AS expected_trips FROM forecast WHERE part = 'forecast'
 ORDER BY yhat DESC, ds LIMIT 5""",
        _FORECAST,
    ),
    "last_90_days": with_tables("gold", _RECENT, _FORECAST),
    "combined_series": with_tables(
        "gold",
        f"""SELECT ds, yhat AS historical, CAST(NULL AS BIGINT) AS forecast,
 CAST(NULL AS BIGINT) AS ci_lower, CAST(NULL AS BIGINT) AS ci_upper FROM ({_RECENT})
 UNION ALL SELECT ds, NULL, yhat, yhat_lower, yhat_upper FROM forecast WHERE part = 'forecast'""",
        _FORECAST,
    ),
}
