"""Bring files with drifting columns to one contract."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.config import TripContract


# Casts that never fail.
SAFE = {
    (a, b)
    for wide in (("tinyint", "smallint", "int", "bigint", "float", "double"), ("date", "timestamp_ntz"), ("timestamp", "timestamp_ntz"))
    for i, a in enumerate(wide) for b in wide[i:]
}
# Source texts of values that their column's type cannot hold, by contract column.
RESCUED = "rescued_values"


def rescue(failed: dict[str, Column], before: Column | None) -> Column:
    """Map from column to source text, of the columns that have one; null if none has."""
    pairs = [x for name, text in failed.items() for x in (F.lit(name), text)]
    found = F.map_filter(F.create_map(*pairs), lambda _, text: text.isNotNull())
    if before is not None:
        # What was rescued when the rows were landed stays.
        kept = F.coalesce(before, F.create_map().cast("map<string,string>"))
        found = F.map_concat(F.map_filter(kept, lambda name, _: ~F.array_contains(F.map_keys(found), name)), found)
    return F.when(F.size(found) > 0, found)


def align(df: DataFrame, contract: TripContract = TripContract()) -> DataFrame:
    """One projection: contract columns first (renamed, cast, missing ones
    null), then every other column untouched.

    A value that its column's type cannot hold becomes null there; its source text is kept
    in the map ``rescued_values``, which is there if some column is cast from text or from a
    type that does not fit.
    """
    have = {contract.canonical(c): c for c in df.columns}
    types = dict(df.dtypes)
    out, failed = [], {}
    for name, dtype in contract.columns.items():
        source = have.get(name)
        if source is None:
            out.append(F.lit(None).cast(dtype).alias(name))
        elif types[source] == dtype:
            out.append(F.col(source).alias(name))
        else:
            value = F.col(source)
            if types[source] == "string" and dtype == "bigint":
                # "3.0" is a whole number too, but not to a direct cast.
                value = value.try_cast("double")
            cast = value.try_cast(dtype)
            out.append(cast.alias(name))
            if (types[source], dtype) not in SAFE:
                failed[name] = F.when(cast.isNull(), F.col(source).cast("string"))
    out += [F.col(source) for name, source in have.items() if name not in contract.columns and not (failed and name == RESCUED)]
    if failed:
        out.append(rescue(failed, F.col(RESCUED) if RESCUED in have else None).alias(RESCUED))
    return df.select(*out)


def union_drifted(frames: Iterable[DataFrame], contract: TripContract = TripContract()) -> DataFrame:
    """Align each frame, then union by name; extra columns are kept."""
    aligned = (align(f, contract) for f in frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)
