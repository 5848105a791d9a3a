"""Web archives: writing records as gzip members and reading them back in splits.

Writing: one member per record.  Of pages with equal payloads of at least
``least_bytes`` bytes, the one with the largest page id is stored as response,
the others as revisits that refer to it and carry its digest and length.  The
files are written by Spark's own text sink, so its commit protocol covers lost
and repeated tasks: members reach it as raw bytes, several to a row, and the
separator between rows is an empty gzip member, which any reader skips.

Reading: a task takes a byte range of a file, looks for the gzip magic,
accepts a candidate if it decodes to a record header, and owns the records
that start inside its range; the last one may end beyond it.  Magic bytes
inside compressed data, empty members and foreign bytes are passed over.  A
member whose header is that of a record but whose data is damaged is reported
as type ``damaged``, never lost unseen.

Defined cases: null payload is empty; null url is an empty target; null page id
gets the record id ``urn:page:`` and is read back as null; of several rows with
one page id and equal payloads all are the response; an empty table gives an
empty archive and no records; other columns are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import text_blocks
from tripmart.session import scratch_path

MAGIC = b"\x1f\x8b\x08"
PAGE_URN = "urn:page:"
RECORDS = (
    "path string, position long, record_type string, record_id string, refers_to string,"
    " url string, payload_digest string, payload_bytes long, payload binary"
)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


SEPARATOR = gzip_member(b"")


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One record; ``refers_to`` is the page id of the response of a revisit, or None."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    body = http + payload if refers_to is None else http
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{PAGE_URN}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if refers_to is not None:
        lines[4:4] = [f"WARC-Refers-To: <{PAGE_URN}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def with_responses(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Pages with digest and, for revisits, the page id of their response."""
    digested = pages.withColumn("digest", F.sha1("payload"))
    responses = (
        digested.where(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response"), F.min("page_id").alias("least"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "response")
    )
    revisit = F.col("page_id").isNull() | (F.col("response") != F.col("page_id"))
    return digested.join(responses, "digest", "left").withColumn(
        "refers_to", F.when(F.col("response").isNotNull() & revisit, F.col("response"))
    )


def write_archive(
    pages: DataFrame, folder: str, least_bytes: int = 1000, date: str = "1970-01-01T00:00:00Z",
    id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", block_bytes: int = 4 << 20,
) -> None:
    """Write one record per page below ``folder``."""
    narrow = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    )

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "payload", block_bytes):
            data = b"".join(
                gzip_member(record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"], date))
                for r in block.to_pylist()
            )
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["members"])

    rows = with_responses(narrow, least_bytes).select("page_id", "url", "payload", "digest", "refers_to")
    (
        rows.mapInArrow(members, "members binary")
        .select(F.col("members").cast("string").alias("value"))
        .write.option("lineSep", SEPARATOR.decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .option("compression", "none")
        .text(folder)
    )


def opened(path: str):
    """Random access to a file of any store that Arrow knows."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    return store.open_input_file(name)


class Window:
    """The bytes of a file from a moving position on, read a block at a time."""

    def __init__(self, file, start: int, block: int = 1 << 20):
        self.file, self.start, self.data, self.block, self.size = file, start, b"", block, file.size()

    def more(self) -> bool:
        at = self.start + len(self.data)
        if at >= self.size:
            return False
        self.file.seek(at)
        self.data += self.file.read(self.block)
        return True

    def drop(self, position: int) -> None:
        """Forget what lies a block or more before ``position``."""
        if position - self.start >= self.block:
            self.data, self.start = self.data[position - self.start :], position

    def find(self, sought: bytes, position: int) -> int:
        """Next place of ``sought`` from ``position`` on, -1 if the file has none."""
        while True:
            self.drop(position)
            found = self.data.find(sought, position - self.start)
            if found >= 0:
                return self.start + found
            position = max(position, self.start + len(self.data) - len(sought) + 1)
            if not self.more():
                return -1

    def piece(self, position: int, most: int = 16_384) -> bytes:
        if position >= self.start + len(self.data):
            self.more()
        return self.data[position - self.start : position - self.start + most]


def decoded(window: Window, start: int) -> tuple[bytes, int, bool] | None:
    """The member at ``start``: data, where it ends, whole or not.

    None if it is not a gzip member that begins with a record header.
    """
    unpack, out, at, checked = zlib.decompressobj(31), [], start, False
    head = b""
    while not unpack.eof:
        part = window.piece(at)
        try:
            got = unpack.decompress(part) if part else None
        except zlib.error:
            got = None
        if got is None:
            return (b"".join(out), at, False) if checked else None
        out.append(got)
        at += len(part) - len(unpack.unused_data)
        if not checked:
            head += got
            if len(head) >= 7 or unpack.eof:
                if not head.startswith(b"WARC/1."):
                    return None
                checked = True
    return b"".join(out), at, True


def members_of(file, start: int, end: int) -> Iterator[tuple[int, bytes, bool]]:
    """Records whose member starts in ``[start, end)``: position, data, whole or not."""
    window = Window(file, start)
    at = window.find(MAGIC, start)
    while 0 <= at < end:
        member = decoded(window, at)
        if member is not None:
            yield at, member[0], member[2]
        at = window.find(MAGIC, member[1] if member is not None and member[2] else at + 1)


def fields(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    named = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return named, body


def parsed(position: int, data: bytes, whole: bool) -> dict:
    """A row of ``RECORDS`` without its path."""
    named, body = fields(data)
    row = {
        "position": position, "record_type": named.get("warc-type"),
        "record_id": named.get("warc-record-id", "").strip("<>"),
        "refers_to": named.get("warc-refers-to", "").strip("<>") or None,
        "url": named.get("warc-target-uri"), "payload_digest": None, "payload_bytes": None, "payload": None,
    }
    length = named.get("content-length", "")
    if not whole or not length.isdigit() or len(body) < int(length):
        return row | {"record_type": "damaged"}
    kind, _, digest = named.get("warc-payload-digest", "").partition(":")
    if kind == "sha1":
        try:
            row["payload_digest"] = base64.b32decode(digest).hex()
        except ValueError:
            row["payload_digest"] = None
    body = body[: int(length)]
    if "application/http" in named.get("content-type", ""):
        http, _, payload = body.partition(b"\r\n\r\n")
        told = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        row["payload_bytes"] = int(told[1]) if told else len(payload)
    else:
        payload, row["payload_bytes"] = body, len(body)
    if row["record_type"] != "revisit":
        row["payload"] = payload
    return row


def read_archive(spark: SparkSession, folder: str, split_bytes: int = 16 << 20) -> DataFrame:
    """Records of all files below ``folder``; payload is null for revisits."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    ranges = files.where("length > 0").select(
        "path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("start")
    ).withColumn("end", F.col("start") + split_bytes)
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = {"position": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows, held = [], 0
                with opened(r["path"]) as file:
                    for found in members_of(file, r["start"], r["end"]):
                        rows.append({"path": r["path"]} | parsed(*found))
                        held += len(found[1])
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    tasks = max(1, ranges.count())
    return ranges.repartition(min(tasks, 100_000), "path", "start").mapInArrow(scan, RECORDS)


def page_digests(records: DataFrame) -> DataFrame:
    """Per page: size and digest of the full payload, type, and what a revisit refers to."""
    page = lambda c: F.regexp_extract(c, f"^{PAGE_URN}(-?[0-9]+)$", 1).try_cast("long")
    kept = F.col("payload").isNotNull()
    return records.select(
        page(F.col("record_id")).alias("page_id"),
        F.when(kept, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(kept, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        page(F.col("refers_to")).alias("refers_to"),
    )


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages to the shared folder and read the archive back."""
    folder = scratch_path(pages.sparkSession, "warc")
    write_archive(pages, folder, **options)
    return read_archive(pages.sparkSession, folder)
