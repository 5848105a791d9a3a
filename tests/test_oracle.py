"""Every registered query against its check SQL, on the small sample."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import check  # noqa: E402

from __spark_entry__ import entry  # noqa: E402
from tripmart.catalog import all_oracles as oracle_sql  # noqa: E402
from tripmart.catalog import all_queries as queries  # noqa: E402

ROWS_ONLY = {
    "rf_regression", "rf_regression_rmse", "rf_tip_class", "rf_tip_scores", "kmeans_zones",
    "silhouette", "forecast_city", "forecast_zones", "ml_month", "full_month", "backtest_zones",
}


@pytest.fixture(scope="module")
def duck(small):
    return check.connect(small)


def test_only_fitted_models_have_no_check_sql():
    assert set(queries()) - set(oracle_sql()) == ROWS_ONLY
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_check_sql(spark, duck, small, name):
    assert check.compare(queries()[name](spark, small), duck.sql(oracle_sql()[name])) == []


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_model_query_gives_rows(spark, small, name):
    assert queries()[name](spark, small).count() > 0


def test_entry(spark):
    rows = entry(spark).collect()
    assert 0 < len(rows) <= 10
    assert [r.total_revenue for r in rows] == sorted((r.total_revenue for r in rows), reverse=True)
