"""Monthly trip analytics on Spark: ingest, clean, aggregate, model, report."""

from tripmart.config import (
    ForecastConfig,
    ModelConfig,
    Months,
    Run,
    TripContract,
    ZoneLabel,
)

__all__ = [
    "ForecastConfig",
    "ModelConfig",
    "Months",
    "Run",
    "TripContract",
    "ZoneLabel",
]
