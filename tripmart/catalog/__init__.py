"""Named queries over the test tables, each with its check query.

Every module has ``QUERIES`` (name -> function of session and table folder)
and ``ORACLE`` (name -> DuckDB query with the same columns and values).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmart.catalog import (
    certificates,
    changes,
    cleaning,
    demand,
    features,
    ingest,
    mart,
    models,
    reports,
    runs,
)
from tripmart.session import prepare

_MODULES = (ingest, cleaning, mart, features, models, demand, reports, runs, changes, certificates)

Query = Callable[[SparkSession, str], DataFrame]


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir)

    run.__doc__ = query.__doc__
    return run


def all_queries() -> dict[str, Query]:
    return {name: _prepared(q) for m in _MODULES for name, q in m.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
