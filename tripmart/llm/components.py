"""Connected components of a table of links, by alternating star contractions.

Each round points every vertex at the smallest vertex it knows (Kiveris et
al., "Connected Components in MapReduce and Beyond", 2014).  All steps are
partial minima and equi-joins, so a vertex with very many links is combined on
the map side and its join can be split.  Every round is stored in the shared
folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import materialise


def _pointed(links: DataFrame) -> DataFrame:
    """Links from the larger to the smaller vertex, each once."""
    hi, lo = F.greatest("a", "b"), F.least("a", "b")
    return links.select(hi.alias("a"), lo.alias("b")).where("a <> b").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Connects the larger neighbours of a vertex to the least of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Connects the smaller neighbours of a vertex and itself to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    others = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``vertex`` and ``component_id``, its component's smallest vertex, for all but those smallest.

    Vertices without links, and links from a vertex to itself or with a null
    end, give no row.
    """
    known = F.col(a).isNotNull() & F.col(b).isNotNull()
    now = materialise(_pointed(links.where(known).select(F.col(a).alias("a"), F.col(b).alias("b"))), "links")
    mark = None
    while True:
        told = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if told == mark:
            return now.select(F.col("a").alias("vertex"), F.col("b").alias("component_id"))
        mark = told
        now = materialise(_pointed(_small_star(_pointed(_large_star(now)))), "links")
