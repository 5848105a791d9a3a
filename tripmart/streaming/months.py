"""Process months as their files arrive.

A stream only tells *which* months got new files.  Those months are then
recomputed from all of their files and their partitions are overwritten, so a
month may arrive in any number of files, and a repeated batch changes nothing.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmart.config import Months, TripContract
from tripmart.plans.elt import rebuild
from tripmart.session import prepare
from tripmart.sources.lake import Lake, file_month
from tripmart.sources.landing import ingest, month_gate, ready_months
from tripmart.sources.records import read_record, write_record


def touched_months(batch: DataFrame) -> list[tuple[int, int]]:
    """Months of a micro-batch (partition values only, a short list)."""
    return sorted((r.year, r.month) for r in batch.select("year", "month").distinct().collect())


def deferred_months(spark: SparkSession, lake: Lake) -> list[tuple[int, int]]:
    """Landed months that the stream has seen and not loaded yet."""
    text = read_record(spark, f"{lake.checkpoints}/_deferred.json")
    return [(year, month) for year, month in json.loads(text or "[]")]


def _defer(spark: SparkSession, lake: Lake, months: list[tuple[int, int]]) -> None:
    if months != deferred_months(spark, lake):
        write_record(spark, f"{lake.checkpoints}/_deferred.json", json.dumps(months))


def follow_raw_table(
    spark: SparkSession,
    lake: Lake,
    contract: TripContract = TripContract(),
    processed_at: str | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Start a query that handles all files present now, then stops.

    Call it again (or on a schedule) for later files; its checkpoint in the
    lake remembers what was seen.
    """
    prepare(spark)
    stamp = None if processed_at is None else F.lit(processed_at).cast("timestamp")

    def on_batch(batch: DataFrame, _batch_id: int) -> None:
        rebuild(batch.sparkSession, lake, touched_months(batch), contract, stamp)

    # Files that a later load of their month has replaced since they were listed
    # are passed over; the month is recomputed from what is there.
    return (
        spark.readStream.schema("year int, month int")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("ignoreMissingFiles", "true")
        .parquet(lake.bronze)
        .select("year", "month")
        .writeStream.option("checkpointLocation", f"{lake.checkpoints}/months")
        .trigger(availableNow=True)
        .foreachBatch(on_batch)
        .start()
    )


def follow_landing(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    contract: TripContract = TripContract(),
    files_per_batch: int = 1000,
    as_of: dt.date | None = None,
) -> StreamingQuery:
    """Start a query that loads all landed files not seen yet, then stops.

    Only the file listing is streamed; the contents are read by the load of the
    months concerned.  Months too recent on day ``as_of`` (default: today) are kept in a
    record beside the stream's checkpoint and offered again whenever this is called and with every
    batch, so they are loaded once they are ready, also if no other file comes.
    """
    prepare(spark)
    day = as_of or dt.date.today()

    def load(session: SparkSession, seen: list[tuple[int, int]]) -> None:
        waiting = sorted({*deferred_months(session, lake), *seen})
        if not waiting:
            return
        landed = session.createDataFrame(waiting, "year int, month int")
        wanted = Months.between("%d-%d" % waiting[0], "%d-%d" % waiting[-1])
        ready = ready_months(month_gate(landed, wanted, day))
        # Recorded before the load: a failure in between leaves them waiting, and a load can be repeated.
        _defer(session, lake, waiting)
        if ready:
            ingest(session, landing, lake.bronze, ready, contract)
            rebuild(session, lake, ready, contract)
            _defer(session, lake, [m for m in waiting if m not in ready])

    def on_batch(batch: DataFrame, _batch_id: int) -> None:
        load(batch.sparkSession, touched_months(batch.where("year IS NOT NULL AND month IS NOT NULL")))

    load(spark, [])

    year, month = file_month(F.col("path"))
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
        .select(year.alias("year"), month.alias("month"))
        .writeStream.option("checkpointLocation", f"{lake.checkpoints}/landing")
        .trigger(availableNow=True)
        .foreachBatch(on_batch)
        .start()
    )
