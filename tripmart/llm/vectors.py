"""Vectors that may be compared, and their way into numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(c):
    """Not null or empty, not zero, every component a finite number."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return c.isNotNull() & F.forall(c, finite) & F.exists(c, lambda v: v != 0)


def comparable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, vector (double), size; rows with null id or an unusable vector are left out."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(usable(F.col("vector")), F.lit(False))).withColumn(
        "size", F.size("vector")
    )


def matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten()).reshape(-1, size)


def distinct_ids(table: pa.Table) -> pa.Table:
    """One row per vec_id: of repeated ids the row that comes first by its vector."""
    ids = table.column("vec_id").to_numpy()
    if len(np.unique(ids)) == len(ids):
        return table
    keys = [tuple(v) for v in table.column("vector").to_pylist()]
    order = sorted(range(len(ids)), key=lambda i: (ids[i], keys[i]))
    kept = [i for n, i in enumerate(order) if n == 0 or ids[order[n - 1]] != ids[i]]
    return table.take(kept)
