"""Small text records, and sizes, in any file system Spark can reach, read and written without a Spark job."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files at or below a path, which may be a pattern as in a reader; 0 if there are none."""
    _, place, files = _located(spark, path)
    return sum(files.getContentSummary(found.getPath()).getLength() for found in files.globStatus(place) or ())


def read_record(spark: SparkSession, path: str) -> str | None:
    """Text of the record, None if it is not there."""
    jvm, place, files = _located(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_record(spark: SparkSession, path: str, text: str) -> None:
    """Replace the record: written beside it under another name first, so no reader sees half of it."""
    jvm, place, files = _located(spark, path)
    folder, name = path.rsplit("/", 1)
    beside = jvm.org.apache.hadoop.fs.Path(f"{folder}/_{uuid.uuid4().hex}-{name.lstrip('_')}")
    files.mkdirs(place.getParent())
    stream = files.create(beside)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if files.exists(place):
        files.delete(place, False)
    if not files.rename(beside, place):
        raise OSError(f"cannot write {path}")
