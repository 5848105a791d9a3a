"""Month filters and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.config import Months


def in_range(column: str, months: Months, dtype: str = "timestamp") -> Column:
    """Half-open range on a time column, in the column's own type.

    A plain comparison with a constant reaches the Parquet statistics, which
    ``year(c) = y`` does not.
    """
    c = F.col(column)
    return (c >= F.lit(months.start_day).cast(dtype)) & (c < F.lit(months.stop_day).cast(dtype))


def in_partitions(months: Months, year: str = "year", month: str = "month") -> Column:
    """The same range on integer partition columns (prunes directories)."""
    index = F.col(year) * 12 + F.col(month) - 1
    return (index >= months.first) & (index < months.stop)


def in_month_list(pairs: list[tuple[int, int]], year: str = "year", month: str = "month") -> Column:
    """Any of the given months; an empty list matches nothing.

    One membership test on one number: it stays small for any number of
    months, and prunes directories where the keys are partition columns.
    """
    wanted = sorted({y * 12 + m - 1 for y, m in pairs})
    return (F.col(year) * 12 + F.col(month) - 1).isin(wanted) if wanted else F.lit(False)


def pickup_parts(pickup: str) -> dict[str, Column]:
    """Hour of day and day of week (1 = Sunday)."""
    return {"pickup_hour": F.hour(pickup), "pickup_day_of_week": F.dayofweek(pickup)}
