"""The read queries on a stored lake.

Each method scans only the partitions and columns it needs and returns a
DataFrame.  Where a table holds several runs, the run of the asked month is
read, or the latest one if no month is given.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tripmart.config import ModelConfig, Months
from tripmart.operators import serving
from tripmart.sources.lake import Lake, in_run, newest_run, read_table


@dataclass(frozen=True)
class Reports:
    spark: SparkSession
    lake: Lake
    cfg: ModelConfig = ModelConfig()

    def _table(self, path: str) -> DataFrame:
        return read_table(self.spark, path)

    def _run(self, path: str, year: int | None, month: int | None) -> DataFrame:
        table = self._table(path)
        if year is None or month is None:
            newest = newest_run(self.spark, path)
            return table.where("false") if newest is None else in_run(table, *newest)
        return in_run(table, year, month)

    def monthly_kpis(self, year: int, month: int) -> DataFrame:
        return serving.monthly_kpis(self._table(self.lake.gold), year, month)

    def kpis_by_month(self) -> DataFrame:
        return serving.kpis_by_month(self._table(self.lake.gold))

    def top_zones_by_revenue(self, year: int, month: int, limit: int = 10) -> DataFrame:
        return serving.top_zones(self._table(self.lake.gold), Months.of(year, month), limit)

    def fare_accuracy(self, year: int, month: int) -> DataFrame:
        return serving.fare_accuracy(self._run(self.lake.fare_predictions, year, month))

    def daily_fares(self, year: int, month: int) -> DataFrame:
        return serving.daily_fares(self._run(self.lake.fare_predictions, year, month))

    def regression_metrics(self, year: int, month: int) -> DataFrame:
        """Accuracy and the daily comparison in one nested row."""
        return serving.fare_report(self._run(self.lake.fare_predictions, year, month), year, month)

    def tip_distribution(self, year: int, month: int) -> DataFrame:
        return serving.tip_distribution(
            self._run(self.lake.tip_predictions, year, month), year, month
        )

    def zone_clusters(self, year: int | None = None, month: int | None = None) -> DataFrame:
        return serving.zone_clusters(self._run(self.lake.clusters, year, month))

    def zones_by_label(self, year: int | None = None, month: int | None = None) -> DataFrame:
        return serving.zones_by_label(self._run(self.lake.clusters, year, month))

    def zone_lists(self, year: int | None = None, month: int | None = None) -> DataFrame:
        return serving.zone_lists(self._run(self.lake.clusters, year, month))

    def _forecast(self, year: int | None, month: int | None) -> DataFrame:
        return self._run(self.lake.forecasts, year, month).drop("run_year", "run_month")

    def forecast(self, year: int | None = None, month: int | None = None) -> DataFrame:
        """History, forecast and peak days in one nested row."""
        return serving.forecast_report(self._forecast(year, month), self.cfg.horizon_days)

    def forecast_points(self, year: int | None = None, month: int | None = None) -> DataFrame:
        """Flat points with their part and the observed demand ``y``."""
        return serving.forecast_parts(self._forecast(year, month), self.cfg.horizon_days)

    def peak_days(self, year: int | None = None, month: int | None = None) -> DataFrame:
        return serving.peak_days(self._forecast(year, month), self.cfg.horizon_days)

    def recent_history(self, year: int | None = None, month: int | None = None) -> DataFrame:
        return serving.recent_history(self._forecast(year, month), self.cfg.horizon_days)

    def combined_series(self, year: int | None = None, month: int | None = None) -> DataFrame:
        return serving.combined_series(self._forecast(year, month), self.cfg.horizon_days)

    def model_metrics(self, year: int, month: int) -> DataFrame:
        return in_run(self._table(self.lake.metrics), year, month)
