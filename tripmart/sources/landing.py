"""Landing folder: which months are there, which may be loaded, loading them."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections import defaultdict
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import PUBLICATION_LAG_DAYS, Months, TripContract
from tripmart.functions.calendar import in_month_list
from tripmart.sources.contract import union_drifted
from tripmart.sources.lake import file_inventory, overwrite_partitions

READY, TOO_RECENT, MISSING = "ready", "too_recent", "missing"
# Where a file written by Spark keeps the types it is read back with.
ROW_METADATA = b"org.apache.spark.sql.parquet.row.metadata"


def month_gate(
    landed: DataFrame, months: Months, as_of: dt.date, lag_days: int = PUBLICATION_LAG_DAYS
) -> DataFrame:
    """Status of every requested month, given the ``(year, month)`` rows landed.

    A month that starts less than ``lag_days`` before ``as_of`` is too recent,
    whether its file is there or not; an older one without a file is missing.
    """
    spark = landed.sparkSession
    first = F.lit(months.start_day).cast("date")
    last = F.lit(Months(months.stop - 1, months.stop).start_day).cast("date")
    wanted = spark.range(1).select(
        F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month_start")
    )
    wanted = wanted.select(
        "month_start", F.year("month_start").alias("year"), F.month("month_start").alias("month")
    )
    present = landed.select("year", "month").distinct().withColumn("landed", F.lit(True))
    cutoff = F.date_sub(F.lit(as_of.isoformat()).cast("date"), lag_days)
    status = (
        F.when(F.col("month_start") > cutoff, TOO_RECENT)
        .when(F.col("landed"), READY)
        .otherwise(MISSING)
    )
    return wanted.join(present, ["year", "month"], "left").select(
        "year", "month", status.alias("status")
    )


def ready_months(gate: DataFrame) -> list[tuple[int, int]]:
    """Loadable months as plain pairs (one per calendar month, so a short list)."""
    rows = gate.where(F.col("status") == READY).select("year", "month").collect()
    return sorted((r.year, r.month) for r in rows)


def missing_months(gate: DataFrame) -> list[tuple[int, int]]:
    rows = gate.where(F.col("status") == MISSING).select("year", "month").collect()
    return sorted((r.year, r.month) for r in rows)


def _footer_print(path: str) -> str | None:
    """Digest of what a file's schema is read from; null where workers cannot open its file system."""
    scheme, _, rest = path.partition(":")
    try:
        if scheme == "file":
            opened, name = fs.LocalFileSystem(), "/" + rest.lstrip("/")
        else:
            opened, name = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}:{quote(rest)}")
        source = opened.open_input_file(name)
    except (OSError, pa.ArrowException):
        return None
    with source, pq.ParquetFile(source) as file:
        told = (file.metadata.metadata or {}).get(ROW_METADATA, b"")
        columns = str(file.schema).partition("\n")[2]  # its first line names the object
        return hashlib.sha256(columns.encode() + b"\0" + told).hexdigest()


def footer_prints(files: DataFrame) -> DataFrame:
    """path, footer: a digest of each file's schema, its footer read in the task that lists it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path")
            prints = pa.array([_footer_print(p) for p in paths.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([paths, prints], names=["path", "footer"])

    return files.select("path").mapInArrow(read, "path string, footer string")


def read_landing(
    spark: SparkSession,
    root: str,
    pairs: list[tuple[int, int]],
    contract: TripContract = TripContract(),
) -> DataFrame:
    """Rows of the given months' files plus the month each file is for.

    Files differ in column types, spelling and columns, also within a month, so
    each is read with the schema of its own footer.  Footers are read in tasks and
    told apart by a digest; the schema of one file per digest is asked for, so the
    number of jobs depends on how many schemas there are, not on how many files.
    (A file whose file system only the JVM can open is asked for by itself.)
    Files with the same schema are read together: the plan has one scan per distinct
    schema (two, if some files carry their month in the name and others in their folders).
    """
    listed = file_inventory(spark, root).where(in_month_list(pairs))
    files = sorted((r.path, r.footer) for r in footer_prints(listed).collect())
    if not files:
        raise FileNotFoundError(f"no landed file for {pairs} in {root}")
    schemas = {}
    for path, footer in files:
        if (footer or path) not in schemas:
            schemas[footer or path] = spark.read.parquet(path).schema
    alike = defaultdict(list)
    for path, footer in files:
        schema = schemas[footer or path]
        alike[schema.json(), "/year=" in path].append((path, schema))

    # The month in the path, by substring: a pattern match would run per row.
    path = F.col("_metadata.file_path")
    stem = F.substring_index(path, ".parquet", 1 + root.count(".parquet"))
    named = (F.substring(stem, -7, 4), F.substring(stem, -2, 2))
    folder = lambda key: F.substring_index(F.substring_index(path, f"/{key}=", -1), "/", 1)
    foldered = (folder("year"), folder("month"))

    def scan(group: list, in_folders: bool) -> DataFrame:
        year, month = foldered if in_folders else named
        months = (year.cast("int").alias("year"), month.cast("int").alias("month"))
        rows = spark.read.schema(group[0][1]).parquet(*[name for name, _ in group])
        return rows.select(*[c for c in rows.columns if c not in ("year", "month")], *months)

    return union_drifted([scan(group, in_folders) for (_, in_folders), group in alike.items()], contract)


def ingest(
    spark: SparkSession,
    landing: str,
    bronze: str,
    pairs: list[tuple[int, int]],
    contract: TripContract = TripContract(),
) -> None:
    """Copy months from landing to the raw table, in the types of the contract.

    A scan task holds rows of one file's month, so no shuffle is needed.  A value
    that its column's type cannot hold becomes null; its text stays in ``rescued_values``.
    """
    overwrite_partitions(read_landing(spark, landing, pairs, contract), bronze, rebuilt=pairs)
