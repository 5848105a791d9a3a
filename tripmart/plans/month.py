"""The full month: load, then train."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tripmart.config import ForecastConfig, ModelConfig, Run, TripContract
from tripmart.plans.elt import run_month
from tripmart.plans.models import run_models
from tripmart.sources.lake import Lake


def run_full_month(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    run: Run,
    contract: TripContract = TripContract(),
    cfg: ModelConfig = ModelConfig(),
    shape: ForecastConfig = ForecastConfig(),
) -> bool:
    """Load a month and, if it could be loaded, train and predict on it."""
    loaded = run_month(spark, landing, lake, run, contract)
    if loaded:
        run_models(spark, lake, run, cfg, shape)
    return loaded
