"""Stupid-backoff scores of documents under n-gram counts of the whole corpus.

Brants et al. (2007): S(w | h) = c(hw) / c(h) if the n-gram hw occurs at least
``least`` times, else 0.4 * S(w | h without its first word); for single words
c(w) / N.  Histories do not cross documents.  A document's score is the sum of
the logarithms.

Three shuffles: documents are dealt into chunks; each chunk sends its distinct
n-grams with their counts to buckets by hash; a bucket adds up the counts of all
chunks, which makes it its part of the count table, and joins them back to the
n-grams of each chunk; a chunk looks up its exploded n-grams and sums per document.
Within a chunk an n-gram is sent once however frequent it is, so a word or
passage in a third of all documents costs a bucket one entry per chunk.  Rows
between the steps hold sorted arrays of n-gram hashes rather than one n-gram, and
chunks and buckets have a bounded size, whatever the size of the corpus.  Texts
cross the network compressed, sorted hashes as compressed differences.

Hashes have 24 bits more than are needed to number the bytes of the corpus: one
n-gram in 16 million is taken for another.

Defined cases: null, empty and blank texts have no words and score 0; a
document shorter than an n-gram uses the histories it has; repeated rows are
documents of their own and count as such; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import materialise, split_count, text_blocks
from tripmart.llm.grams import chained, word_hashes

ASKED = "chunk long, bucket long, grams binary, counts binary"
ANSWERED = "chunk long, bucket long, totals binary"
SCORED = "doc_id long, n_words long, part double, singles long"


def key_bits(size: int) -> int:
    """Bits of the n-gram hashes for a corpus of ``size`` bytes."""
    return min(62, max(48, size.bit_length() + 24))


def numbered_grams(hashes: np.ndarray, stops: np.ndarray, order: int, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n from 1 to ``order``: last places of the n-grams within documents, and their keys.

    A key is ``bits`` bits of hash and two that tell n.
    """
    begin = np.repeat(np.r_[0, stops[:-1]], np.diff(np.r_[0, stops])) if len(stops) else np.zeros(0, np.int64)
    place = np.arange(len(hashes)) - begin
    out = []
    for n in range(1, order + 1):
        last = np.flatnonzero(place >= n - 1)
        keys = chained(hashes, n)[last - (n - 1)] if len(last) else np.zeros(0, np.uint64)
        out.append((last, keys >> np.uint64(64 - bits) << np.uint64(2) | np.uint64(n)))
    return out


def packed_texts(docs: DataFrame) -> DataFrame:
    """The texts of doc_id, text, chunk as compressed frames."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for block in text_blocks(batches, "text"):
            frames = [packer.compress(t or b"") for t in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("chunk"), pa.array(frames, pa.binary())],
                names=["doc_id", "chunk", "frame"],
            )

    return docs.mapInArrow(pack, "doc_id long, chunk long, frame binary")


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, so that the high bytes shrink to nothing."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: np.ndarray) -> np.ndarray:
    return data.reshape(8, -1).T.copy().view("<u8").ravel()


def packed_numbers(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(planes(values))


def unpacked_numbers(data: bytes) -> np.ndarray:
    return from_planes(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8))


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys: lower halves as they are, differences of the upper halves compressed."""
    steps = np.diff(keys >> np.uint64(32), prepend=np.uint64(0))
    return keys.astype("<u4").tobytes() + zstandard.ZstdCompressor(level=1).compress(planes(steps))


def unpacked_keys(data: bytes, n: int) -> np.ndarray:
    steps = from_planes(np.frombuffer(zstandard.ZstdDecompressor().decompress(data[4 * n :]), np.uint8))
    return np.cumsum(steps, dtype=np.uint64) << np.uint64(32) | np.frombuffer(data, "<u4", n)


def grams_of(frames: pa.ChunkedArray, order: int, bits: int):
    unpacker = zstandard.ZstdDecompressor()
    hashes, stops = word_hashes(pa.array([unpacker.decompress(f) for f in frames.to_pylist()], pa.large_binary()))
    numbered = numbered_grams(hashes, stops, order, bits)
    return hashes, stops, numbered


def bucket_edges(buckets: int, bits: int) -> np.ndarray:
    """Smallest key of every bucket; the bits that tell n stay clear."""
    return np.array([(i << bits + 2) // buckets & ~3 for i in range(buckets)], np.uint64)


def scores(
    docs: DataFrame, order: int = 3, least: int = 2, backoff: float = 0.4, id_col: str = "doc_id",
    text_col: str = "text", chunk_bytes: int = 6 << 20, bucket_bytes: int = 4 << 20,
) -> DataFrame:
    """Per document: doc_id, n_words, log_score (natural logarithm) and its mean per word.

    ``order`` is at most 3, the largest n that a key tells.
    """
    if not 1 <= order <= 3:
        raise ValueError("order must be 1, 2 or 3")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    size = narrow.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks, buckets = split_count(size, chunk_bytes), split_count(size, bucket_bytes)
    bits = key_bits(size)
    edges = bucket_edges(buckets, bits)

    def ask(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        _, _, numbered = grams_of(table.column("frame"), order, bits)
        keys, counts = np.unique(np.concatenate([k for _, k in numbered]), return_counts=True)
        cuts = np.r_[np.searchsorted(keys, edges), len(keys)]
        filled = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
        spans = [(b, slice(cuts[b], cuts[b + 1])) for b in filled]
        return pa.table({
            "chunk": pa.array([chunk] * len(filled), pa.int64()), "bucket": pa.array(filled, pa.int64()),
            "grams": pa.array([packed_keys(keys[s] - edges[b]) for b, s in spans], pa.binary()),
            "counts": pa.array([packed_numbers(counts[s]) for _, s in spans], pa.binary()),
        })

    def answer(table: pa.Table) -> pa.Table:
        each = [unpacked_numbers(c) for c in table.column("counts").to_pylist()]
        held = [unpacked_keys(g, len(c)) for g, c in zip(table.column("grams").to_pylist(), each)]
        keys, place = np.unique(np.concatenate(held), return_inverse=True)
        total = np.bincount(place, np.concatenate(each)).astype(np.int64)  # exact below 2 to the 53
        # A history of words is counted in full; what is too rare is not found at all.
        total[(total < least) & ((keys & np.uint64(3)) > 1)] = 0
        parts = np.split(total[place], np.cumsum([len(h) for h in held])[:-1])
        return table.select(["chunk", "bucket"]).append_column("totals", pa.array([packed_numbers(p) for p in parts], pa.binary()))

    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.int64())], names=["doc_id", "n_words", "part", "singles"])
        hashes, stops, numbered = grams_of(texts.column("frame"), order, bits)
        keys, place = np.unique(np.concatenate([k for _, k in numbered]), return_inverse=True)
        answers = answers.sort_by("bucket")
        totals = np.concatenate([np.zeros(0, np.int64), *(unpacked_numbers(t).astype(np.int64) for t in answers.column("totals").to_pylist())])
        if len(totals) != len(keys):
            raise ValueError("the counts of a chunk do not belong to its documents")
        found, at = [], 0
        for last, own in numbered:
            count = np.zeros(len(hashes), np.int64)
            count[last] = totals[place[at : at + len(own)]]
            found.append(count)
            at += len(own)
        value, single = np.zeros(len(hashes)), np.ones(len(hashes), bool)
        steps = np.full(len(hashes), order - 1)
        for n in range(order, 1, -1):
            hit = single & (found[n - 1] > 0)
            at = np.flatnonzero(hit)
            value[at] = np.log(found[n - 1][at] / found[n - 2][at - 1])
            single[at] = False
            steps[at] = order - n
        place_in = np.arange(len(hashes)) - np.repeat(np.r_[0, stops[:-1]], np.diff(np.r_[0, stops]))
        # Backing off starts from the longest history that the document has.
        steps -= np.maximum(0, order - 1 - place_in)
        value[single] = np.log(found[0][single])
        value += steps * np.log(backoff)
        ones = np.r_[0, np.cumsum(single)]
        begins = np.r_[0, stops[:-1]]
        sums = np.array([value[a:b].sum() for a, b in zip(begins, stops)])
        return pa.table({
            "doc_id": texts.column("doc_id"), "n_words": pa.array(stops - begins), "part": pa.array(sums, pa.float64()),
            "singles": pa.array(ones[stops] - ones[begins]),
        })

    # The same exchange serves both steps that read the texts.
    dealt = packed_texts(narrow.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks))))
    answers = dealt.groupBy("chunk").applyInArrow(ask, ASKED).groupBy("bucket").applyInArrow(answer, ANSWERED)
    parts = materialise(
        dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, SCORED), "scores"
    )
    words = parts.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    log_score = F.col("part") - F.col("singles") * float(np.log(max(words, 1)))
    return parts.select(
        "doc_id", "n_words", log_score.alias("log_score"),
        F.when(F.col("n_words") > 0, log_score / F.col("n_words")).alias("mean_log_score"),
    )
