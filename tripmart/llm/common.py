"""Reading the tables, bounded text blocks inside tasks, stored intermediate tables, rows picked by stored keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count, islice

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import materialise

__all__ = ["Recent", "among", "materialise", "path_of", "read", "row_blocks", "split_count", "text_blocks", "without"]

# Bits of a sieve per key, in one piece of it, and pieces at most: 4 KB each, 8 MB in all.
SIEVE_EACH, SIEVE_PIECE, SIEVE_MOST = 32, 1 << 15, 1 << 11


def path_of(sf_dir: str, table: str) -> str:
    return f"{sf_dir.rstrip('/')}/{table}.parquet"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(path_of(sf_dir, table))


def text_blocks(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches of about ``limit`` bytes of text, one row at least.

    A task's memory then follows the block and the longest single text, not
    the number of rows that Spark puts into one batch.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            size = size or 0
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if batch.num_rows > start:
            yield batch.slice(start)


def row_blocks(count: int, size: int) -> Iterator[tuple[int, int]]:
    for start in range(0, count, size):
        yield start, min(count, start + size)


def split_count(rows: int, per_split: int, least: int = 1) -> int:
    """Splits of about ``per_split`` rows."""
    return max(least, -(-rows // per_split))


def _sieved(rows: DataFrame, keys: DataFrame, key: str, held: int) -> tuple[DataFrame, Column, list[str]]:
    """``rows`` beside a sieve of ``held`` keys, whether their key may be among these, and the columns that were added.

    The sieve is a table of bits, one set for the hash of each key, so a key whose bit is not set is surely not
    there.  Its size has a fixed bound and it is broadcast, so rows stay where they are; with very many keys
    more rows than those of the keys may be there.
    """
    pieces = min(max(1, -(-held * SIEVE_EACH // SIEVE_PIECE)), SIEVE_MOST)
    taken = {c.lower() for c in rows.columns}
    at = next(i for i in count() if not {f"sieve_piece_{i}", f"sieve_bits_{i}"} & taken)
    piece, bits = f"sieve_piece_{at}", f"sieve_bits_{at}"
    place = F.pmod(F.xxhash64(F.col(key).cast(rows.schema[key].dataType)), F.lit(pieces * SIEVE_PIECE))
    inside = F.pmod(place, F.lit(SIEVE_PIECE))
    number = F.floor(place / SIEVE_PIECE)
    sieve = keys.groupBy(number.alias(piece)).agg(F.bitmap_construct_agg(inside).alias(bits))
    met = rows.join(F.broadcast(sieve), number == F.col(piece), "left")
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(inside / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(inside, F.lit(8)))), F.lit(2)) == 1
    return met, F.coalesce(bit, F.lit(False)), [piece, bits]


def without(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is not among ``keys``, a stored narrow table; only rows that may be among them are shuffled.

    Rows are read twice: what is surely not there passes at once, the rest is joined.
    """
    held = keys.count()
    if not held:
        return rows
    met, may_be, added = _sieved(rows, keys, key, held)
    rest = met.where(may_be).drop(*added).join(keys.select(key), key, "left_anti")
    return met.where(~may_be).drop(*added).unionByName(rest.select(rows.columns))


def among(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is among ``keys``, a stored narrow table; only rows that may be among them are shuffled."""
    held = keys.count()
    if not held:
        return rows.where(F.lit(False))
    met, may_be, added = _sieved(rows, keys, key, held)
    return met.where(may_be).drop(*added).join(keys.select(key), key, "left_semi").select(rows.columns)


class Recent:
    """What was worked out for the keys seen last, in two generations of at most ``most`` entries.

    A full younger generation becomes the older one, and the older one is dropped
    but for the entries that are asked for again, so frequent keys stay.
    """

    def __init__(self, most: int):
        self.most = most
        self._young: dict = {}
        self._old: dict = {}

    def __len__(self) -> int:
        return len(self._young) + len(self._old)

    def add(self, fresh: dict) -> None:
        if len(self._young) + len(fresh) > self.most:
            self._old, self._young = self._young, {}
        if len(fresh) > self.most:
            fresh = dict(islice(fresh.items(), self.most))
        self._young.update(fresh)

    def values(self, keys: list, solve: Callable[[list], list], keep: Callable[[object], bool] | None = None) -> list:
        """Values of distinct keys, which are never None; ``solve`` is given those that are not held."""
        found = list(map(self._young.get, keys))
        gaps = [i for i, value in enumerate(found) if value is None]
        if not gaps:
            return found
        moved, lost, old = {}, [], self._old
        for i in gaps:
            value = old.get(keys[i])
            if value is None:
                lost.append(i)
            else:
                found[i] = moved[keys[i]] = value
        if lost:
            asked = [keys[i] for i in lost]
            for i, key, value in zip(lost, asked, solve(asked)):
                found[i] = value
                if keep is None or keep(key):
                    moved[key] = value
        self.add(moved)
        return found
