"""Demand forecast."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.catalog.common import big, sample_gold, sample_silver, with_tables
from tripmart.config import ForecastConfig
from tripmart.functions.exact import whole_trips
from tripmart.operators import features, forecast
from tripmart.session import materialise

SHAPE = ForecastConfig()
HORIZON = 30


def _city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.daily_demand(sample_gold(spark, sf_dir))


def calendar_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.spine(_city(spark, sf_dir), HORIZON)


def fourier_design(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trend, hinge, yearly and weekly columns of every day, six decimals."""
    city = materialise(_city(spark, sf_dir), "city")
    columns = forecast.design(F.col("ds"), forecast.history_of(city), SHAPE)
    days = forecast.spine(city, HORIZON)
    return days.select("ds", *[F.round(c, 6).alias(n) for n, c in columns.items()])


def naive_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.naive(materialise(_city(spark, sf_dir), "city"), HORIZON)


def forecast_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Halves, whole numbers and negatives through the trip-count rounding."""
    value = (F.col("total_amount") * 2).cast("double") / 4 - 15
    silver = sample_silver(spark, sf_dir)
    return silver.select("trip_key", value.alias("value"), whole_trips(value).alias("trips"))


def forecast_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    city = materialise(_city(spark, sf_dir), "city")
    history = forecast.history_of(city)
    model = forecast.fit_city(city, history, SHAPE)
    return forecast.forecast_city(model, city, history, HORIZON, SHAPE)


def forecast_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["PULocationID"]
    series = materialise(features.daily_demand(sample_gold(spark, sf_dir), tuple(keys)), "zones")
    history = forecast.history_of(series)
    fitted = forecast.fit_many(series, keys, history, SHAPE)
    return forecast.forecast_many(fitted, keys, history, HORIZON, SHAPE)


def forecast_adds_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients of the zones add up to those of the city; bands are ordered and not below 0."""
    keys = ["PULocationID"]
    gold = materialise(sample_gold(spark, sf_dir), "gold")
    city, zones = features.daily_demand(gold), features.daily_demand(gold, tuple(keys))
    history = forecast.history_of(city)
    whole = forecast.fit_city(city, history, SHAPE)
    parts = materialise(forecast.fit_many(zones, keys, history, SHAPE), "fitted")
    sums = parts.select(F.posexplode("beta").alias("at", "b")).groupBy("at").agg(F.sum("b").alias("b"))
    ones = whole.select(F.posexplode("beta").alias("at", "c"))
    close = F.abs(F.col("b") - F.col("c")) <= 1e-6 * (1 + F.abs(F.col("c")))
    equal = sums.join(ones, "at").agg(F.count("*").alias("terms"), F.min(close).alias("adds_up"))
    bands = forecast.forecast_many(parts, keys, history, HORIZON, SHAPE).agg(
        F.count_distinct("PULocationID").alias("zones"),
        F.min((F.col("yhat_lower") >= 0) & (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))).alias("ordered"),
    )
    one = F.lit(1)
    return equal.withColumn("one", one).join(bands.withColumn("one", one), "one").drop("one")


QUERIES = {
    "forecast_adds_up": forecast_adds_up,
    "calendar_spine": calendar_spine,
    "fourier_design": fourier_design,
    "naive_forecast": naive_forecast,
    "forecast_rounding": forecast_rounding,
    "forecast_city": forecast_city,
    "forecast_zones": forecast_zones,
}

CITY_SQL = f"""city AS (SELECT pickup_date AS ds, {big("SUM(total_trips)")} AS y
 FROM gold GROUP BY pickup_date),
ends AS (SELECT MIN(ds) AS lo, MAX(ds) AS hi FROM city)"""

_SPINE = f"""{CITY_SQL},
spine AS (SELECT CAST(unnest(generate_series(lo, hi + {HORIZON}, INTERVAL 1 DAY)) AS DATE) AS ds, lo, hi FROM ends),
scaled AS (SELECT *, CAST(ds - lo AS DOUBLE) / (hi - lo) AS t, ds - DATE '1970-01-01' AS d FROM spine)"""


def _design_sql() -> str:
    columns = ["CAST(1.0 AS DOUBLE) AS one", "ROUND(t, 6) AS t"]
    for j in range(1, SHAPE.hinges + 1):
        at = SHAPE.hinge_range * j / SHAPE.hinges
        columns.append(f"ROUND(GREATEST(t - {at!r}::DOUBLE, 0), 6) AS hinge_{j}")
    for name, period, order in (("year", 365.25, SHAPE.yearly_order), ("week", 7, SHAPE.weekly_order)):
        for k in range(1, order + 1):
            angle = f"d * {2 * math.pi * k / period!r}::DOUBLE"
            columns.append(f"ROUND(SIN({angle}), 6) AS {name}_sin_{k}")
            columns.append(f"ROUND(COS({angle}), 6) AS {name}_cos_{k}")
    return ",\n ".join(columns)


ORACLE = {
    "forecast_adds_up": with_tables(
        "gold",
        f"""SELECT CAST({SHAPE.terms} AS BIGINT) AS terms, TRUE AS adds_up,
 COUNT(DISTINCT PULocationID) AS zones, TRUE AS ordered FROM gold""",
    ),
    "calendar_spine": with_tables("gold", "SELECT ds, lo, hi FROM spine", _SPINE),
    "fourier_design": with_tables("gold", f"SELECT ds, {_design_sql()} FROM scaled", _SPINE),
    "naive_forecast": with_tables(
        "gold",
        """SELECT s.ds, m.mean AS yhat_naive FROM spine s LEFT JOIN (
  SELECT dow, CAST(SUM(y) AS DOUBLE) / COUNT(*) AS mean FROM (
   SELECT dayofweek(ds) AS dow, y, ROW_NUMBER() OVER (PARTITION BY dayofweek(ds) ORDER BY ds DESC) AS r
   FROM city) WHERE r <= 4 GROUP BY dow) m ON dayofweek(s.ds) = m.dow
 WHERE s.ds > s.hi""",
        _SPINE,
    ),
    "forecast_rounding": with_tables(
        "silver",
        f"""SELECT trip_key, value, {big("round_even(GREATEST(value, 0), 0)")} AS trips
 FROM (SELECT trip_key, CAST(total_c * 2 / 100.0 AS DOUBLE) / 4 - 15 AS value FROM silver)""",
    ),
}
