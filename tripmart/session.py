"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Bytes of stored files that one task reads and sorts by partition before it writes them.
SORTED_BYTES = 32 << 20


def local_session(cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tripmart")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        # Off: recording the Python call site of every column expression,
        # which costs more than building a wide plan itself.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the plans rely on.

    * Zone: trip files hold wall-clock times without a zone.
    * Method limit: the JVM leaves methods of more than 8000 bytes uncompiled.
      The wide cleaning projection can exceed that once other expressions are
      merged into it; with this limit Spark splits it up instead.
    """
    wanted = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    for key, value in wanted.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def small_scans(spark: SparkSession, most: int = SORTED_BYTES) -> Iterator[None]:
    """Scans that run within this block read at most ``most`` bytes of files in a task.

    A write without a shuffle sorts what each task reads by partition, and a row in the sort takes about
    ten times its bytes in the file, so the default split of 128 MB would take more than 1 GB.  Smaller tasks also
    leave fewer cores idle at the end.  A session that reads less already is left as it is.
    """
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key, None)
    if spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() <= most:
        yield
        return
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under a folder that driver and executors share.

    That is the one named by ``spark.checkpoint.dir``, else the warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage like a checkpoint, but stays columnar, so later reads
    still prune columns, and survives the loss of any executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
