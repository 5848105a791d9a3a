import math

import numpy as np
import pytest
from helpers import day
from pyspark.sql import functions as F

from tripmart.config import ForecastConfig
from tripmart.operators import features, forecast, serving
from tripmart.session import materialise

SHAPE = ForecastConfig()


@pytest.fixture(scope="module")
def seasonal(spark):
    """Four years of two zones with known weekly and yearly signals."""
    df = spark.sql(
        f"""SELECT zone, ds, cast(round(zone * (200 + 0.05 * n
              + 40 * sin({2 * math.pi} * unix_date(ds) / 365.25)
              + 25 * cos({2 * math.pi} * unix_date(ds) / 7))) as bigint) AS y
            FROM (SELECT zone, n, date_add(date'2020-01-01', cast(n as int)) AS ds
                  FROM (SELECT explode(sequence(0, 1460)) AS n) LATERAL VIEW explode(array(1, 3)) z AS zone)"""
    )
    return materialise(df, "seasonal")


def test_design_in_sql_and_in_tasks_agree(spark, seasonal):
    history = forecast.history_of(seasonal)
    assert history == (day("2020-01-01"), day("2023-12-31"))
    columns = forecast.design(F.col("ds"), history, SHAPE)
    days = forecast.spine(seasonal)
    got = np.array(
        [r.x for r in days.orderBy("ds").select(F.array(*columns.values()).alias("x")).collect()]
    )
    want = forecast.design_matrix(history, SHAPE)
    assert got.shape == want.shape == (1461, SHAPE.terms)
    assert np.abs(got - want).max() < 1e-9
    assert len(forecast.penalties(SHAPE)) == SHAPE.terms


def test_zone_fit_equals_a_direct_ridge_solve(seasonal):
    history = forecast.history_of(seasonal)
    fitted = {r.zone: r for r in forecast.fit_many(seasonal, ["zone"], history, SHAPE).collect()}
    x = forecast.design_matrix(history, SHAPE)
    for zone in (1, 3):
        rows = seasonal.where(F.col("zone") == zone).orderBy("ds").collect()
        y = np.array([r.y for r in rows], dtype=float)
        beta = np.linalg.solve(x.T @ x + np.diag(forecast.penalties(SHAPE)), x.T @ y)
        assert np.abs(np.array(fitted[zone].beta) - beta).max() < 1e-5 * np.abs(beta).max()
        assert fitted[zone].sigma == pytest.approx(np.sqrt(np.mean((y - x @ beta) ** 2)), rel=1e-4)


def truth(ds):
    epoch = (ds - day("1970-01-01")).days
    n = (ds - day("2020-01-01")).days
    return (
        200 + 0.05 * n + 40 * math.sin(2 * math.pi * epoch / 365.25) + 25 * math.cos(2 * math.pi * epoch / 7)
    )


def test_zone_forecast_recovers_the_seasons(seasonal):
    history = forecast.history_of(seasonal)
    fitted = forecast.fit_many(seasonal, ["zone"], history, SHAPE)
    out = forecast.forecast_many(fitted, ["zone"], history, 30, SHAPE)
    future = out.where(F.col("ds") > "2023-12-31").collect()
    assert len(future) == 60
    for r in future:
        assert r.yhat == pytest.approx(r.zone * truth(r.ds), rel=0.05)
        assert 0 <= r.yhat_lower <= r.yhat <= r.yhat_upper


def test_city_forecast_recovers_the_seasons(seasonal):
    city = seasonal.groupBy("ds").agg(F.sum("y").alias("y"))
    history = forecast.history_of(city)
    model = forecast.fit_city(city, history, SHAPE)
    out = forecast.forecast_city(model, city, history, 30, SHAPE)
    assert out.count() == 1461 + 30
    future = out.where("y IS NULL").collect()
    assert len(future) == 30
    for r in future:
        assert r.yhat == pytest.approx(4 * truth(r.ds), rel=0.05)


def test_sample_forecast_is_not_worse_than_the_baseline(gold_table):
    """Hold out the last 30 days of the sample city series."""
    city = features.daily_demand(gold_table)
    last = city.agg(F.max("ds")).first()[0]
    past = materialise(city.where(F.col("ds") <= F.date_sub(F.lit(last), 30)), "past")
    history = forecast.history_of(past)
    model = forecast.fit_city(past, history, SHAPE)
    fitted = forecast.forecast_city(model, past, history, 30, SHAPE).where("y IS NULL").drop("y")
    joined = fitted.join(forecast.naive(past, 30), "ds").join(city, "ds")
    row = joined.agg(
        F.sqrt(F.avg((F.col("y") - F.col("yhat")) ** 2)).alias("model"),
        F.sqrt(F.avg((F.col("y") - F.col("yhat_naive")) ** 2)).alias("naive"),
    ).first()
    assert row.model <= 1.05 * row.naive


def test_unobserved_zone_days_count_as_zero(spark):
    rows = [(z, day("2024-01-01"), 10) for z in (1, 2)] + [(1, day("2024-03-31"), 10)]
    series = spark.createDataFrame(rows, "zone int, ds date, y bigint")
    history = forecast.history_of(series)
    fitted = forecast.fit_many(series, ["zone"], history, SHAPE)
    out = forecast.forecast_many(fitted, ["zone"], history, 2, SHAPE)
    assert {r["count"] for r in out.groupBy("zone").count().collect()} == {91 + 2}
    assert out.agg(F.min("yhat_lower")).first()[0] == 0


def test_empty_history_is_refused(spark):
    with pytest.raises(ValueError):
        forecast.history_of(spark.createDataFrame([], "ds date, y bigint"))


# -- reports on a forecast table --------------------------------------------


@pytest.fixture(scope="module")
def points(spark):
    return materialise(
        spark.sql(
            """SELECT date_add(date'2024-01-01', n) AS ds, cast((n * 7) % 50 as bigint) AS yhat,
                 cast(0 as bigint) AS yhat_lower, cast(60 as bigint) AS yhat_upper
               FROM (SELECT explode(sequence(0, 199)) AS n)"""
        ),
        "points",
    )


def test_split_at_the_last_thirty_days(points):
    parts = serving.forecast_parts(points)
    ends = {
        r.part: (r.a, r.b, r.n)
        for r in parts.groupBy("part").agg(
            F.min("ds").alias("a"), F.max("ds").alias("b"), F.count("*").alias("n")
        ).collect()
    }
    assert ends["forecast"] == (day("2024-06-19"), day("2024-07-18"), 30)
    assert ends["historical"][1] == day("2024-06-18") and ends["historical"][2] == 170


def test_peak_days_are_the_five_highest_with_ties_by_date(points):
    future = serving.forecast_parts(points).where("part = 'forecast'").collect()
    want = sorted(future, key=lambda r: (-r.yhat, r.ds))[:5]
    got = serving.peak_days(points).collect()
    assert [(r.date, r.expected_trips) for r in got] == [(r.ds, r.yhat) for r in want]


def test_combined_series_has_one_side_per_day(points):
    rows = serving.combined_series(points).collect()
    assert len(rows) == 120
    assert all((r.historical is None) != (r.forecast is None) for r in rows)
    assert serving.recent_history(points).count() == 90


def test_nested_report_equals_the_flat_queries(points):
    row = serving.forecast_report(points).first()
    assert len(row.historical) == 170 and len(row.forecast) == 30
    flat = [(r.date, r.expected_trips) for r in serving.peak_days(points).collect()]
    assert [(p.date, p.expected_trips) for p in row.peak_days] == flat
    assert row.forecast[0].ds == day("2024-06-19")
