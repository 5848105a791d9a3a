"""Tables of the lake: where they are, how to read and overwrite them."""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart.config import Months
from tripmart.functions.calendar import in_month_list, in_partitions
from tripmart.session import small_scans
from tripmart.sources.records import read_record, write_record
from tripmart.sources.schema import merged_schema

log = logging.getLogger(__name__)

MONTH_KEYS = ("year", "month")
RUN_KEYS = ("run_year", "run_month")


@dataclass(frozen=True)
class Lake:
    """Folder layout under one root (any file system Spark can reach)."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def bronze(self) -> str:
        return self.table("bronze")

    @property
    def silver(self) -> str:
        return self.table("silver")

    @property
    def gold(self) -> str:
        return self.table("gold")

    @property
    def fare_predictions(self) -> str:
        return self.table("ml/predictions/regression")

    @property
    def tip_predictions(self) -> str:
        return self.table("ml/predictions/classification")

    @property
    def zone_profiles(self) -> str:
        return self.table("ml/zone_profiles")

    @property
    def clusters(self) -> str:
        return self.table("ml/clusters")

    @property
    def forecasts(self) -> str:
        return self.table("ml/forecasts")

    @property
    def zone_forecasts(self) -> str:
        return self.table("ml/zone_forecasts")

    @property
    def metrics(self) -> str:
        return self.table("ml/metrics")

    @property
    def checkpoints(self) -> str:
        return self.table("_stream_checkpoints")


SCHEMA_RECORD = "_schema.json"


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema record of a table; None if it has none.  No Spark job."""
    text = read_record(spark, f"{path.rstrip('/')}/{SCHEMA_RECORD}")
    return None if text is None else StructType.fromJson(json.loads(text))


def _schema_after(df: DataFrame, path: str, keys: tuple[str, str]) -> StructType:
    """Schema of the table once ``df`` is written; raises where a type would change."""
    known = stored_schema(df.sparkSession, path)
    if known is None:
        # A table from before there were records: its footers are merged once.
        try:
            known = df.sparkSession.read.option("mergeSchema", "true").parquet(path).schema
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return merged_schema(known, df.schema, keys)


def read_table(
    spark: SparkSession,
    path: str,
    months: Months | None = None,
    columns: Sequence[str] | None = None,
    schema: StructType | None = None,
    keys: tuple[str, str] = MONTH_KEYS,
) -> DataFrame:
    """Scan of a month- or run-partitioned table.

    ``months`` becomes a partition filter and ``columns`` the read schema; both
    are done by the optimizer.  A month that was never written gives no rows.

    Without ``schema`` the table has the columns of its schema record, which every
    write keeps up to date: a column that came with a later month is null before
    it.  No file is opened and no job runs until rows are asked for.  Only a table
    without a record has its footers merged, by a distributed job.
    """
    schema = schema or stored_schema(spark, path)
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    if months is not None:
        df = df.where(in_partitions(months, *keys))
    return df if columns is None else df.select(*columns)


def warn_if_empty(df: DataFrame, what: str) -> bool:
    """Log a warning for an input without rows; reads at most one row."""
    empty = df.isEmpty()
    if empty:
        log.warning("no rows in %s", what)
    return empty


def file_month(path: Column, keys: tuple[str, str] = MONTH_KEYS) -> tuple[Column, Column]:
    """Year and month of a file, from ``year=/month=`` folders or from a
    ``YYYY-MM.parquet`` name; null if the path has neither."""

    def part(folder: str, group: int) -> Column:
        by_folder = F.regexp_extract(path, folder, 1)
        by_name = F.regexp_extract(path, r"(\d{4})-(\d{2})\.parquet", group)
        return F.coalesce(by_folder.try_cast("int"), by_name.try_cast("int"))

    return part(rf"/{keys[0]}=(\d+)/", 1), part(rf"/{keys[1]}=(\d+)/", 2)


def file_inventory(spark: SparkSession, root: str, keys: tuple[str, str] = MONTH_KEYS) -> DataFrame:
    """Parquet files below ``root``: path, size, time and month.

    Only the listing is read; the contents column is pruned.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    year, month = file_month(F.col("path"), keys)
    return files.select(
        "path",
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
        year.alias("year"),
        month.alias("month"),
    )


def stored_partitions(spark: SparkSession, path: str, keys: tuple[str, str] = MONTH_KEYS) -> DataFrame:
    """Distinct partition keys of a stored table, as ``keys``, from its listing; no data file is opened.

    A partition that was replaced by an empty one is listed too.  A table that is not
    there has none.
    """
    try:
        listed = file_inventory(spark, path, keys)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ", ".join(f"{k} int" for k in keys))
    found = listed.where("year IS NOT NULL AND month IS NOT NULL").groupBy("year", "month").agg(F.count("*").alias("files"))
    return found.select(F.col("year").alias(keys[0]), F.col("month").alias(keys[1]))


def newest_run(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """The most recent run of a run-partitioned table, from its listing; it may have no rows."""
    newest = stored_partitions(spark, path, RUN_KEYS).agg(F.max(F.struct(*RUN_KEYS)).alias("run")).first().run
    return None if newest is None else (newest[0], newest[1])


def month_inventory(table: DataFrame, keys: tuple[str, str] = MONTH_KEYS) -> DataFrame:
    """Distinct months of a table or of a file listing."""
    return table.select(*keys).distinct()


def stored_files(
    spark: SparkSession, path: str, keys: tuple[str, str], pairs: Sequence[tuple[int, int]]
) -> dict[tuple[int, int], set[str]]:
    """Paths of the files of the given partitions, from the listing."""
    try:
        listed = file_inventory(spark, path, keys)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    found: dict[tuple[int, int], set[str]] = {}
    for r in listed.where(in_month_list(pairs)).select("year", "month", "path").collect():
        found.setdefault((r.year, r.month), set()).add(r.path)
    return found


def overwrite_partitions(
    df: DataFrame,
    path: str,
    keys: tuple[str, str] = MONTH_KEYS,
    rebalance: bool = False,
    rows_per_file: int = 20_000_000,
    rebuilt: Sequence[tuple[int, int]] | None = None,
) -> None:
    """Replace the partitions that occur in ``df``, and those named in ``rebuilt``.

    The overwrite mode is an option of this write, not of the session.  With
    ``rebalance=False`` tasks write what they hold, which needs no shuffle and
    is right when the input is laid out by month already; each task sorts what it
    read by partition, so it reads a bounded number of bytes (``small_scans``).  ``rebalance=True``
    is for scattered input: it shuffles by partition key to sized partitions,
    and a month of any size is split over as many tasks as it needs.  A shuffle to more than 200
    tasks sorts what each task read too, so its scans are bounded alike.

    A partition of ``rebuilt`` that got no row still holds its old files after
    the write; it is replaced by an empty one, so readers see its old rows for a
    moment longer than those of the others.

    Columns that are new to the table are added to its schema record; a column whose type
    neither stays nor widens (see ``merged_schema``) stops the write before anything is stored.
    """
    spark, pairs = df.sparkSession, list(rebuilt or ())
    schema = _schema_after(df, path, keys)
    before = stored_files(spark, path, keys, pairs) if pairs else {}
    rows = df.hint("rebalance", *[F.col(k) for k in keys]) if rebalance else df
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with small_scans(spark):
        writer.option("maxRecordsPerFile", rows_per_file).partitionBy(*keys).parquet(path)
    if schema != stored_schema(spark, path):
        write_record(spark, f"{path.rstrip('/')}/{SCHEMA_RECORD}", schema.json())
    after = stored_files(spark, path, keys, list(before)) if before else {}
    empty = spark.createDataFrame([], df.drop(*keys).schema)
    for pair, names in before.items():
        if names & after.get(pair, set()):
            folder = "/".join(f"{k}={v}" for k, v in zip(keys, pair))
            empty.coalesce(1).write.mode("overwrite").parquet(f"{path}/{folder}")


def overwrite_run(df: DataFrame, path: str, year: int, month: int, rebalance: bool = False) -> None:
    """Replace the result of one run, also by an empty one, keeping all other runs."""
    keyed = df.withColumns({RUN_KEYS[0]: F.lit(year), RUN_KEYS[1]: F.lit(month)})
    overwrite_partitions(keyed, path, RUN_KEYS, rebalance, rebuilt=[(year, month)])


def in_run(table: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of one run."""
    return table.where((F.col(RUN_KEYS[0]) == year) & (F.col(RUN_KEYS[1]) == month))


def latest_run(table: DataFrame) -> DataFrame:
    """Rows of the most recent run of a run-partitioned table.

    The newest run key is a scalar subquery over partition values, so the main
    scan stays a single pass.
    """
    key = F.col(RUN_KEYS[0]) * 12 + F.col(RUN_KEYS[1])
    newest = table.agg(F.max(key)).scalar()
    return table.where(key == newest)
