"""What a clustering must satisfy, computed from sums per cluster.

Sums per cluster are a few rows (one per cluster), held in the plan as one
scalar value, so points are neither paired nor shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _dot(a: Column, b: Column, width: int) -> Column:
    return reduce(add, [F.get(a, F.lit(i)) * F.get(b, F.lit(i)) for i in range(width)])


def cluster_sums(points: DataFrame, x: str, cluster: str, width: int) -> DataFrame:
    """``cluster, n, total, squares`` of each cluster: size, sum of its points, sum of their squared lengths."""
    at = F.col(x)
    return points.groupBy(F.col(cluster).alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(F.get(at, F.lit(i))) for i in range(width)]).alias("total"),
        F.sum(_dot(at, at, width)).alias("squares"),
    )


def silhouettes(points: DataFrame, x: str, cluster: str, width: int) -> DataFrame:
    """``points`` with ``silhouette`` for squared Euclidean distance.

    The mean squared distance from a point p to the n points of a cluster is
    |p|^2 + Q/n - 2 p.S/n, with S the sum of the points and Q of their squared
    lengths, so no pair of points is formed.  A point alone in its cluster has
    0; with a single cluster all are null.
    """
    groups = cluster_sums(points, x, cluster, width)
    every = groups.agg(F.sort_array(F.collect_list(F.struct("cluster", "n", "total", "squares")))).scalar()
    p, own = F.col(x), F.col(cluster)

    def mean(c: Column) -> Column:
        return _dot(p, p, width) + c["squares"] / c["n"] - 2 * _dot(p, c["total"], width) / c["n"]

    wide = points.withColumn("cluster_groups", every)
    mine = F.get(F.filter(F.col("cluster_groups"), lambda c: c["cluster"] == own), F.lit(0))
    others = F.filter(F.col("cluster_groups"), lambda c: c["cluster"] != own)
    wide = wide.withColumns({"own_group": mine, "apart": F.array_min(F.transform(others, mean))})
    group = F.col("own_group")
    inside = mean(group) * group["n"] / (group["n"] - 1)
    wide = wide.withColumn("inside", F.when(group["n"] > 1, inside))
    larger = F.greatest("inside", "apart")
    value = (
        F.when(F.col("apart").isNull(), F.lit(None).cast("double"))
        .when(group["n"] == 1, 0.0)
        .when(larger == 0, 0.0)
        .otherwise((F.col("apart") - F.col("inside")) / larger)
    )
    return wide.withColumn("silhouette", value).drop("cluster_groups", "own_group", "inside", "apart")


def fixed_point(
    points: DataFrame, x: str, cluster: str, centres: Sequence[Sequence[float]], tolerance: float = 1e-6
) -> DataFrame:
    """Per cluster whether its centre is the mean of its members, and no member is nearer to another.

    ``cluster, n, centred, nearest``; a cluster without members has no row.
    Both hold where Lloyd's iteration has come to rest.
    """
    width = len(centres[0])
    lists = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])
    p = F.col(x)

    def apart(c: Column) -> Column:
        return reduce(add, [(F.get(p, F.lit(i)) - F.get(c, F.lit(i))) ** 2 for i in range(width)])

    centre = F.get(lists, F.col(cluster))
    least = F.array_min(F.transform(lists, apart))
    near = points.withColumn("nearest", apart(centre) <= least + tolerance)
    means = near.groupBy(F.col(cluster).alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(F.get(p, F.lit(i))) for i in range(width)]).alias("mean"),
        F.bool_and("nearest").alias("nearest"),
    )
    own = F.get(lists, F.col("cluster"))
    gaps = [F.abs(F.get(F.col("mean"), F.lit(i)) - F.get(own, F.lit(i))) for i in range(width)]
    centred = F.greatest(*gaps, F.lit(0.0)) <= tolerance
    return means.select("cluster", "n", centred.alias("centred"), "nearest")
