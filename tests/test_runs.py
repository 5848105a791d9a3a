import datetime as dt

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from tripmart.catalog.common import sample_landing
from tripmart.config import Months, Run
from tripmart.operators import windows
from tripmart.plans import elt
from tripmart.plans.month import run_full_month
from tripmart.plans.reports import Reports
from tripmart.session import scratch_path
from tripmart.sources.lake import Lake, read_table

AS_OF = dt.date(2002, 6, 1)


@pytest.fixture(scope="module")
def reports(spark, medium):
    """A lake with history up to 1998-03 and full runs of two months."""
    landing = sample_landing(spark, medium)
    lake = Lake(scratch_path(spark, "lake"))
    elt.backfill(spark, landing, lake, Months.between("1995-01", "1998-04"), AS_OF)
    for month in (2, 3):
        assert run_full_month(spark, landing, lake, Run(1998, month, AS_OF))
    return Reports(spark, lake)


def test_every_report_answers(reports):
    kpi = reports.monthly_kpis(1998, 3).first()
    assert kpi.total_trips > 0 and 0 < kpi.data_trust_score <= 100
    assert reports.top_zones_by_revenue(1998, 3).count() == 10
    assert reports.top_zones_by_revenue(1998, 3, 3).count() == 3
    nested = reports.regression_metrics(1998, 3).first()
    assert 0 < nested.accuracy_pct < 100 and len(nested.daily_comparison) == 31
    assert reports.daily_fares(1998, 3).count() == 31
    tips = reports.tip_distribution(1998, 3).first()
    assert tips.high_pct + tips.medium_pct + tips.low_pct == pytest.approx(100, abs=0.02)
    assert reports.zones_by_label().agg(F.sum("zones")).first()[0] == 25
    assert reports.recent_history().count() == 90
    assert reports.combined_series().count() == 120
    assert reports.peak_days().count() == 5
    row = reports.forecast().first()
    assert len(row.forecast) == 30 and len(row.peak_days) == 5
    assert row.forecast[-1].ds == dt.date(1998, 4, 30)


def test_default_is_the_latest_run_once(reports):
    latest = reports.zone_clusters()
    assert latest.count() == latest.select("pu_location_id").distinct().count() == 25
    days = reports.forecast_points()
    assert days.count() == days.select("ds").distinct().count()
    older = reports.forecast_points(1998, 2).agg(F.max("ds")).first()[0]
    assert older == dt.date(1998, 3, 30)


def test_latest_run_prunes_partitions(reports):
    text = plan_of(reports.zone_clusters())
    line = next(x for x in text.splitlines() if "PartitionFilters" in x)
    assert "(run_year#" in line and "= 1998)" in line  # the run comes from the listing


def test_month_report_reads_one_partition_and_few_columns(reports):
    text = plan_of(reports.monthly_kpis(1998, 3))
    line = next(x for x in text.splitlines() if "PartitionFilters" in x)
    assert "year" in line and "month" in line
    schema = next(x for x in text.splitlines() if "ReadSchema" in x)
    assert "avg_distance" not in schema and "total_revenue" in schema


def test_metrics_are_stored_per_run(reports):
    rows = {(r.model, r.metric): r.value for r in reports.model_metrics(1998, 3).collect()}
    assert set(rows) == {
        ("fare_regression", "rmse"), ("tip_classification", "accuracy"),
        ("tip_classification", "weighted_f1"), ("zone_clusters", "silhouette"),
        ("city_forecast", "fit_rmse"),
    }
    assert rows["tip_classification", "accuracy"] > 0.5
    assert reports.model_metrics(1998, 2).count() == 5


def test_predictions_cover_the_run_month_only(reports):
    table = read_table(reports.spark, reports.lake.fare_predictions)
    silver = read_table(reports.spark, reports.lake.silver)
    march = windows.prediction_window(silver, Months.of(1998, 3)).where("passenger_count IS NOT NULL")
    assert table.where("run_month = 3").count() == march.count()
    assert table.where("run_month = 3 AND month(tpep_pickup_datetime) <> 3").isEmpty()


def test_observed_demand_is_beside_the_fit(reports):
    parts = reports.forecast_points()
    assert parts.where("part = 'forecast' AND y IS NOT NULL").isEmpty()
    assert parts.where("part = 'historical' AND y IS NOT NULL").count() > 1000


def test_no_python_outside_the_zone_solver(reports):
    for df in (reports.monthly_kpis(1998, 3), reports.forecast(), reports.tip_distribution(1998, 3)):
        text = plan_of(df)
        assert "Python" not in text and "InPandas" not in text
