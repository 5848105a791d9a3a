"""Reporting queries over the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.config import TIP_HIGH, TIP_LOW, TIP_MEDIUM, Months
from tripmart.functions.calendar import in_partitions
from tripmart.functions.exact import from_units, ratio_half_up, units
from tripmart.operators.gold import trust_score


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("double")


def _kpis() -> list[Column]:
    trips = F.sum("total_trips")
    tips = F.sum(units(F.col("total_tips_profit")))
    flagged = F.sum("flagged_incorrect_trips")
    return [
        _or_zero(from_units(F.sum(units(F.col("total_revenue"))))).alias("total_revenue"),
        F.coalesce(trips, F.lit(0)).alias("total_trips"),
        _or_zero(ratio_half_up(tips, trips * 100)).alias("avg_tip"),
        _or_zero(trust_score(flagged, trips)).alias("data_trust_score"),
    ]


def monthly_kpis(gold: DataFrame, year: int, month: int) -> DataFrame:
    """One row of KPIs; a month without data gives zeros."""
    picked = gold.where(in_partitions(Months.of(year, month)))
    return picked.agg(*_kpis()).select(
        F.lit(year).alias("year"), F.lit(month).alias("month"), "*"
    )


def kpis_by_month(gold: DataFrame) -> DataFrame:
    """The same KPIs for every stored month."""
    return gold.groupBy("year", "month").agg(*_kpis())


def top_zones(gold: DataFrame, months: Months, limit: int = 10) -> DataFrame:
    """Zones with the highest revenue; ties go to the lower zone number."""
    revenue = F.sum(units(F.col("total_revenue")))
    return (
        gold.where(in_partitions(months))
        .groupBy("PULocationID")
        .agg(from_units(revenue).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "PULocationID")
        .limit(limit)
        .select(
            F.col("PULocationID").alias("pu_location_id"),
            F.col("total_revenue").cast("double").alias("total_revenue"),
        )
    )


# -- fare model -------------------------------------------------------------


def _cents_mean(column: str) -> Column:
    """Two-decimal mean of a double, on the exact sum of its 1e-6 units."""
    return ratio_half_up(F.sum(units(F.col(column), 6)), F.count(column) * 1_000_000)


def fare_accuracy(predictions: DataFrame, tolerance: float = 2) -> DataFrame:
    """Share of predictions within ``tolerance`` of the actual total.

    Errors are compared in whole 1e-9 units, so that the noise of a binary
    subtraction does not push an error of exactly ``tolerance`` outside.
    """
    error = F.abs(F.col("total_amount") - F.col("predicted_total_amount"))
    close = units(error, 9) <= int(tolerance * 10**9)
    share = ratio_half_up(F.count_if(close), F.count(F.lit(1)), factor=100)
    return predictions.agg(_or_zero(share).alias("accuracy_pct"))


def daily_fares(predictions: DataFrame) -> DataFrame:
    """Mean actual and predicted total per day of month."""
    return predictions.groupBy(F.dayofmonth("tpep_pickup_datetime").alias("day")).agg(
        _cents_mean("total_amount").cast("double").alias("avg_real"),
        _cents_mean("predicted_total_amount").cast("double").alias("avg_predicted"),
    )


def fare_report(predictions: DataFrame, year: int, month: int) -> DataFrame:
    """Accuracy and the daily comparison as one nested row.

    The array has one element per day of month, so at most 31.
    """
    days = daily_fares(predictions).agg(
        F.sort_array(F.collect_list(F.struct("day", "avg_real", "avg_predicted"))).alias("days")
    )
    return fare_accuracy(predictions).select(
        F.lit(year).alias("year"),
        F.lit(month).alias("month"),
        "accuracy_pct",
        days.scalar().alias("daily_comparison"),
    )


# -- tip model --------------------------------------------------------------


def tip_distribution(predictions: DataFrame, year: int, month: int) -> DataFrame:
    """Share of each tip class, actual and, where present, predicted."""
    total = F.count(F.lit(1))

    def share(column: str, label: str) -> Column:
        return _or_zero(ratio_half_up(F.count_if(F.col(column) == label), total, factor=100))

    names = {"high": TIP_HIGH, "medium": TIP_MEDIUM, "low": TIP_LOW}
    shares = [share("tip_label", label).alias(f"{n}_pct") for n, label in names.items()]
    if "predicted_tip_label" in predictions.columns:
        shares += [
            share("predicted_tip_label", label).alias(f"predicted_{n}_pct")
            for n, label in names.items()
        ]
    return predictions.agg(*shares).select(
        F.lit(year).alias("year"), F.lit(month).alias("month"), "*"
    )


# -- zones ------------------------------------------------------------------


def zone_clusters(clusters: DataFrame) -> DataFrame:
    """Zones with cluster, label and two-decimal profile."""

    def two(column: str) -> Column:
        return F.round(F.col(column), 2).alias(column)

    return clusters.select(
        F.col("PULocationID").alias("pu_location_id"),
        "cluster",
        "cluster_label",
        two("avg_revenue"),
        two("avg_distance"),
        two("avg_duration_minutes"),
        two("avg_tip_efficiency"),
        F.col("total_trips").cast("bigint").alias("total_trips"),
    )


def zones_by_label(clusters: DataFrame) -> DataFrame:
    """Number and mean position of the zones under each label, flat.

    The points of the scatter chart are the rows of :func:`zone_clusters`;
    gathering them into one list per label would put a whole label in one row.
    """
    return clusters.groupBy("cluster_label").agg(
        F.count(F.lit(1)).alias("zones"),
        F.round(F.avg("avg_revenue"), 2).alias("avg_revenue"),
        F.round(F.avg("avg_distance"), 2).alias("avg_distance"),
    )


def zone_lists(clusters: DataFrame) -> DataFrame:
    """The zones of each label as one list of points, by zone, for a scatter chart.

    One row per label.  A list is as long as the label has zones; zones are places
    of one city, not rows of the data.
    """
    point = F.struct("pu_location_id", "cluster", "avg_revenue", "avg_distance", "total_trips")
    return (
        zone_clusters(clusters)
        .groupBy("cluster_label")
        .agg(F.sort_array(F.collect_list(point)).alias("zones"))
    )


# -- forecast ---------------------------------------------------------------


def forecast_parts(forecast: DataFrame, horizon: int = 30) -> DataFrame:
    """Every point marked ``historical`` or ``forecast``.

    The last ``horizon`` days are the forecast.  The newest day is a scalar
    subquery, not a join.
    """
    newest = forecast.agg(F.max("ds")).scalar()
    part = F.when(F.col("ds") < F.date_sub(newest, horizon - 1), "historical").otherwise("forecast")
    return forecast.withColumn("part", part)


def peak_days(forecast: DataFrame, horizon: int = 30, limit: int = 5) -> DataFrame:
    """Forecast days with the most expected trips; ties go to the earlier day."""
    return (
        forecast_parts(forecast, horizon)
        .where(F.col("part") == "forecast")
        .orderBy(F.desc("yhat"), "ds")
        .limit(limit)
        .select(F.col("ds").alias("date"), F.col("yhat").alias("expected_trips"))
    )


def recent_history(forecast: DataFrame, horizon: int = 30, days: int = 90) -> DataFrame:
    """The newest ``days`` historical points."""
    return (
        forecast_parts(forecast, horizon)
        .where(F.col("part") == "historical")
        .orderBy(F.desc("ds"))
        .limit(days)
        .drop("part")
    )


def combined_series(forecast: DataFrame, horizon: int = 30, days: int = 90) -> DataFrame:
    """Recent history and forecast in one table, null where not applicable."""
    newest = forecast.agg(F.max("ds")).scalar()
    start = F.date_sub(newest, horizon - 1)
    # The history has one point per day, so its newest points are a date range
    # of the distinct days; the limit keeps this right across missing days.
    past = forecast.where(F.col("ds") < start).orderBy(F.desc("ds")).limit(days)
    none = F.lit(None).cast("bigint")
    left = past.select(
        "ds",
        F.col("yhat").alias("historical"),
        none.alias("forecast"),
        none.alias("ci_lower"),
        none.alias("ci_upper"),
    )
    right = forecast.where(F.col("ds") >= start).select(
        "ds",
        none.alias("historical"),
        F.col("yhat").alias("forecast"),
        F.col("yhat_lower").alias("ci_lower"),
        F.col("yhat_upper").alias("ci_upper"),
    )
    return left.unionByName(right)


def forecast_report(forecast: DataFrame, horizon: int = 30) -> DataFrame:
    """History, forecast and peak days of one series as one nested row.

    Arrays have one element per calendar day (``forecast`` holds one series).
    """
    point = F.struct("ds", "yhat", "yhat_lower", "yhat_upper")

    def points(name: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("part") == name, point))).alias(name)

    days = forecast_parts(forecast, horizon).agg(points("historical"), points("forecast"))
    ranked = F.array_sort(
        F.col("forecast"),
        lambda a, b: F.when(
            a["yhat"] != b["yhat"], F.when(a["yhat"] > b["yhat"], -1).otherwise(1)
        ).otherwise(F.when(a["ds"] < b["ds"], -1).when(a["ds"] > b["ds"], 1).otherwise(0)),
    )
    peaks = F.transform(
        F.slice(ranked, 1, 5),
        lambda p: F.struct(p["ds"].alias("date"), p["yhat"].alias("expected_trips")),
    )
    return days.select("historical", "forecast", peaks.alias("peak_days"))
