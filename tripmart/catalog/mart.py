"""Zone-by-day mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.catalog.common import (
    RUN_MONTH,
    big,
    dollars,
    half_up,
    plain,
    project,
    sample_gold,
    with_tables,
)
from tripmart.operators import gold as mart


def gold_zone_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(sample_gold(spark, sf_dir))


def gold_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(mart.report_order(sample_gold(spark, sf_dir, RUN_MONTH)))


def gold_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(
        sample_gold(spark, sf_dir),
        "pickup_date", "PULocationID", "total_trips", "flagged_incorrect_trips", "data_trust_score",
    )


def gold_tip_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(
        sample_gold(spark, sf_dir),
        "pickup_date", "PULocationID", "total_tips_profit", "tip_efficiency_pct",
    )


def gold_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(mart.rollup(sample_gold(spark, sf_dir)))


QUERIES = {
    "gold_zone_day": gold_zone_day,
    "gold_month": gold_month,
    "gold_trust": gold_trust,
    "gold_tip_efficiency": gold_tip_efficiency,
    "gold_rollup": gold_rollup,
}


def _grain(name: str, month: str, zone: str, group: str) -> str:
    return f"""SELECT '{name}' AS grain, CAST({month} AS INT) AS month_key, CAST({zone} AS INT) AS zone,
 {big("SUM(total_trips)")} AS total_trips,
 {big("SUM(flagged_incorrect_trips)")} AS flagged_incorrect_trips,
 {dollars("SUM(revenue_c)")} AS total_revenue, {dollars("SUM(tips_c)")} AS total_tips_profit,
 {half_up("(SUM(total_trips) - SUM(flagged_incorrect_trips)) * 100", "SUM(total_trips)")} AS data_trust_score
 FROM gold_cents{group}"""


_KEY = "year * 100 + month"

ORACLE = {
    "gold_zone_day": with_tables("gold", "SELECT * FROM gold"),
    "gold_month": with_tables("gold", "SELECT * FROM gold WHERE year = 1998 AND month = 3"),
    "gold_trust": with_tables(
        "gold",
        """SELECT pickup_date, PULocationID, total_trips, flagged_incorrect_trips, data_trust_score
 FROM gold""",
    ),
    "gold_tip_efficiency": with_tables(
        "gold",
        "SELECT pickup_date, PULocationID, total_tips_profit, tip_efficiency_pct FROM gold",
    ),
    "gold_rollup": with_tables(
        "gold_cents",
        "\nUNION ALL\n".join(
            [
                _grain("month_zone", _KEY, "PULocationID", f" GROUP BY {_KEY}, PULocationID"),
                _grain("month", _KEY, "NULL", f" GROUP BY {_KEY}"),
                _grain("zone", "NULL", "PULocationID", " GROUP BY PULocationID"),
                _grain("total", "NULL", "NULL", ""),
            ]
        ),
    ),
}
