"""Row buckets that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(columns: Sequence[str], buckets: int = 100, purpose: str = "split") -> Column:
    """Stable bucket number of a row, from a hash of the named columns.

    Different purposes give independent buckets.
    """
    return F.pmod(F.xxhash64(F.lit(purpose), *[F.col(c) for c in columns]), F.lit(buckets))
