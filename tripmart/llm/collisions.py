"""Nearest neighbours by counting collisions of single projections.

Every shard keeps ``projections`` random projections of its vectors as sorted
arrays.  A query is projected too, and a window around its own value opens in
each array; a vector collides in an array when it lies in the window.  Windows
grow by a factor per round (virtual rehashing: the arrays stay as they are), only
the new ends are counted, and vectors whose collisions reach the threshold are
verified by exact distance.  A query stops when it has verified enough of its
shard (64 rows and ``share`` of it beyond the neighbours wanted) or its windows hold all.

Shards are dealt by a hash of the id, queries are sent to every shard in blocks;
each shard answers with its nearest, and the answers are merged.

Defined cases: vectors that are null, zero or hold null or non-finite components
take no part; only vectors of equal length are compared; an id that repeats
counts once; a query with fewer candidates gets them all; ties go to the smaller
id, and all copies at one distance are verified in the same round, as they
collide alike; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import materialise, split_count
from tripmart.llm.vectors import comparable, distinct_ids, matrix

FOUND = "query_id long, vec_id long, score double"


class CollisionIndex:
    """Sorted projections of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int = 64, seed: int = 11):
        self.ids, self.vectors = ids, vectors
        rng = np.random.default_rng(seed)
        self.axes = rng.standard_normal((vectors.shape[1], projections))
        values = vectors @ self.axes
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(values.T, self.order, axis=1)
        # The first half window; later ones are multiples of it.
        self.width = 0.1 * float(values.std(axis=0).mean()) or 1e-9

    def search(
        self, query_id: int, query: np.ndarray, k: int, threshold: float = 0.7, growth: float = 1.3,
        share: float = 0.08,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of up to ``k`` nearest vectors other than the query's row."""
        n, m = len(self.ids), len(self.order)
        at = query @ self.axes
        counts = np.zeros(n, np.int32)
        wanted, need = min(n, k + 64 + int(share * n)), max(1, int(np.ceil(threshold * m)))
        left = np.array([np.searchsorted(v, a) for v, a in zip(self.values, at)])
        right, half = left.copy(), self.width
        while True:
            fresh = []
            for j in range(m):
                row = self.values[j]
                lo = np.searchsorted(row[: left[j]], at[j] - half)
                hi = right[j] + np.searchsorted(row[right[j] :], at[j] + half, side="right")
                fresh += [self.order[j, lo : left[j]], self.order[j, right[j] : hi]]
                left[j], right[j] = lo, hi
            counts += np.bincount(np.concatenate(fresh), minlength=n)
            over = np.flatnonzero(counts >= need)
            if len(over) >= wanted or (left.max() == 0 and right.min() == n):
                break
            half *= growth
        over = over[self.ids[over] != query_id]
        far = np.sqrt(np.square(self.vectors[over] - query).sum(axis=1))
        best = np.lexsort((self.ids[over], far))[:k]
        return self.ids[over][best], far[best]


def nearest(
    df: DataFrame, is_query: Column, k: int = 10, projections: int = 64, shard_rows: int = 20_000,
    least_shards: int = 6, query_block: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding",
    **search: float,
) -> DataFrame:
    """The ``k`` nearest found for each query row: query_id, rank, vec_id, score.

    ``is_query`` is a condition on ``vec_id``.  A task holds one shard and one
    block of queries.
    """
    rows = materialise(comparable(df, id_col, vector_col), "vectors")
    queries = rows.where(is_query)
    shards = split_count(rows.count(), shard_rows, least_shards)
    blocks = split_count(queries.count(), query_block)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    held = rows.withColumn("shard", dealt(shards)).withColumn("block", every(blocks))
    asked = queries.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int")).withColumn("shard", every(shards))

    def answer(vectors: pa.Table, asks: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not vectors.num_rows or not asks.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())], names=names)
        vectors, asks = distinct_ids(vectors), distinct_ids(asks)
        size = vectors.column("size")[0].as_py()
        index = CollisionIndex(vectors.column("vec_id").to_numpy(), matrix(vectors.column("vector"), size), projections)
        out = [[], [], []]
        for one, query in zip(asks.column("vec_id").to_numpy(), matrix(asks.column("vector"), size)):
            ids, far = index.search(int(one), query, k, **search)
            out[0].append(np.full(len(ids), one))
            out[1].append(ids)
            out[2].append(far)
        return pa.table([pa.array(np.concatenate(c)) for c in out], names=names)

    keys = ["size", "shard", "block"]
    found = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(answer, FOUND)
    by = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(by).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
