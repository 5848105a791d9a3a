"""Quality scores by a small convolutional network over the bytes of a text.

A text is its UTF-8 bytes.  Learned byte vectors feed learned filters that
slide over chunks in steps of two bytes (``STEP``); neighbouring chunks overlap, so
every byte of a text is covered, however long, also across chunks.  Windows that
begin at odd places are not seen: a byte put in front of a text shifts all.  Each
filter is max-pooled per chunk; the chunks of a text are combined by their
maximum and their mean, and a logistic layer gives one probability.

Learning runs on the driver over a sample of bounded size (``per_class`` rows of
each label, texts of at most ``longest`` bytes); scoring runs in tasks over
blocks of bounded size.  Maximum and sum of chunks are carried across blocks, so
a very long text costs no more memory than a block.

Defined cases: null or empty text is one chunk of padding and gets a score;
repeated rows get equal scores; labels other than 0 and 1, null labels and
labels without a document teach nothing; without rows of both labels every
score is the share of label 1 (0.5 without labels); an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import text_blocks

WIDTH, DEPTH, STEP, FILTERS, CHUNK = 8, 6, 2, 24, 256
PLACES = CHUNK // STEP


@dataclass
class Network:
    """Weights; ``constant`` replaces the network where there was nothing to learn from."""

    vectors: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    shift: float
    constant: float | None = None


def chunks_of(text: bytes) -> int:
    return max(1, -(-len(text) // CHUNK))


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of chunk bytes (with the overlap) and the number of rows of each text.

    The last chunk of a text is filled up with zero bytes.
    """
    counts = np.array([chunks_of(t) for t in texts])
    flat = np.frombuffer(
        b"".join(t.ljust(n * CHUNK, b"\0") for t, n in zip(texts, counts)) + bytes(WIDTH), np.uint8
    )
    rows = np.lib.stride_tricks.sliding_window_view(flat, CHUNK + WIDTH - STEP)[::CHUNK].copy()
    # What follows the last chunk of a text is another text, not its own bytes.
    rows[np.cumsum(counts) - 1, CHUNK:] = 0
    return rows, counts


def windows(net: Network, rows: np.ndarray) -> np.ndarray:
    """Byte vectors of every window: chunks x places x (width * depth)."""
    seen = net.vectors[rows].reshape(len(rows), -1)
    view = np.lib.stride_tricks.sliding_window_view(seen, WIDTH * DEPTH, axis=1)
    return np.ascontiguousarray(view[:, :: STEP * DEPTH][:, :PLACES])


def pooled(net: Network, rows: np.ndarray, batch: int = 256) -> np.ndarray:
    """Largest answer of each filter in each chunk."""
    out = np.empty((len(rows), FILTERS), np.float32)
    for i in range(0, len(rows), batch):
        out[i : i + batch] = (windows(net, rows[i : i + batch]) @ net.filters).max(axis=1)
    return out + net.bias


def combined(tops: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Maximum and mean over the chunks of each text."""
    starts = np.cumsum(counts) - counts
    return np.concatenate(
        [np.maximum.reduceat(tops, starts), np.add.reduceat(tops, starts) / counts[:, None]], axis=1
    )


def probability(net: Network, features: np.ndarray) -> np.ndarray:
    z = features.astype(np.float64) @ net.dense.astype(np.float64) + net.shift
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit(texts: list[bytes], labels: np.ndarray, rounds: int = 10, batch: int = 64, seed: int = 7) -> Network:
    """Adam on the logistic loss; gradients pass only through the pooled windows."""
    rng = np.random.default_rng(seed)
    start = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    net = Network(
        start(256, DEPTH, scale=0.5), start(WIDTH * DEPTH, FILTERS, scale=0.2),
        np.zeros(FILTERS, np.float32), start(2 * FILTERS, scale=0.1), 0.0,
    )
    share = labels.mean() if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        net.constant = float(share)
        return net
    names = ("vectors", "filters", "bias", "dense", "shift")
    first = {k: np.zeros_like(getattr(net, k), np.float32) for k in names}
    second = {k: np.zeros_like(getattr(net, k), np.float32) for k in names}
    # Both labels weigh the same, however rare one is in the sample.
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    step, steps = 0, rounds * -(-len(texts) // batch)
    for _ in range(rounds):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), batch):
            part = order[i : i + batch]
            rows, counts = laid_out([texts[j] for j in part])
            answers = np.empty((len(rows), FILTERS), np.float32)
            where = np.empty((len(rows), FILTERS), np.int64)
            for a in range(0, len(rows), 256):
                response = windows(net, rows[a : a + 256]) @ net.filters
                where[a : a + 256] = response.argmax(axis=1)
                answers[a : a + 256] = response.max(axis=1)
            tops = answers + net.bias
            features = combined(tops, counts)
            error = ((probability(net, features) - labels[part]) * weight[part] / len(part)).astype(np.float32)
            slope = {"dense": features.T @ error, "shift": error.sum()}
            back = error[:, None] * net.dense[None]
            owner = np.repeat(np.arange(len(part)), counts)
            down = back[owner, FILTERS:] / counts[owner, None]
            is_top = tops >= features[owner, :FILTERS]
            down = down + back[owner, :FILTERS] * is_top
            slope["bias"] = down.sum(axis=0)
            at = where[:, :, None] * STEP + np.arange(WIDTH)
            bytes_at = rows[np.arange(len(rows))[:, None, None], at]
            seen = net.vectors[bytes_at].reshape(len(rows), FILTERS, -1)
            slope["filters"] = np.einsum("cfk,cf->kf", seen, down)
            slope["vectors"] = np.zeros_like(net.vectors)
            to_bytes = (down[:, :, None] * net.filters.T[None]).reshape(-1, DEPTH)
            for d in range(DEPTH):
                slope["vectors"][:, d] = np.bincount(bytes_at.ravel(), to_bytes[:, d], 256)
            step += 1
            pace = 0.02 * (1 - step / (steps + 1))
            for k in names:
                first[k] = 0.9 * first[k] + 0.1 * slope[k]
                second[k] = 0.999 * second[k] + 0.001 * np.square(slope[k])
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                setattr(net, k, getattr(net, k) - pace * move)
    net.shift = float(net.shift)
    return net


def score_texts(net: Network, texts: list[bytes], block: int = 4096) -> np.ndarray:
    """Probabilities; a long text is scored in blocks of chunks."""
    if net.constant is not None:
        return np.full(len(texts), net.constant)
    out = np.empty(len(texts))
    usual = [i for i, t in enumerate(texts) if chunks_of(t) <= block]
    if usual:
        rows, counts = laid_out([texts[i] for i in usual])
        out[usual] = probability(net, combined(pooled(net, rows), counts))
    for i in set(range(len(texts))) - set(usual):
        text, best, total, chunks = texts[i], np.full(FILTERS, -np.inf), np.zeros(FILTERS), 0
        for at in range(0, len(text), block * CHUNK):
            rows, counts = laid_out([text[at : at + block * CHUNK]])
            over = text[at + block * CHUNK : at + block * CHUNK + WIDTH - STEP]
            rows[-1, CHUNK : CHUNK + len(over)] = np.frombuffer(over, np.uint8)
            tops = pooled(net, rows)
            best, total, chunks = np.maximum(best, tops.max(axis=0)), total + tops.sum(axis=0), chunks + len(rows)
        out[i] = probability(net, np.concatenate([best, total / chunks])[None])[0]
    return out


def learned(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", per_class: int = 1500,
    longest: int = 32_768, id_col: str = "doc_id", text_col: str = "text",
) -> Network:
    """Fit on at most ``per_class`` documents of each label, chosen by a hash of the id.

    Rows whose ``crc32(id) mod 3`` is 1 are held out and never learned from.
    """
    key = F.col(id_col).cast("long")
    taught = (
        labels.select(key.alias("id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out("id"))
        .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
    )
    # The rows are chosen by id and size alone, before any text is moved.
    sized = docs.select(key.alias("id"), F.octet_length(F.col(text_col)).alias("size"))
    known = (
        sized.where(F.col("size").between(1, longest))
        .groupBy("id").agg(F.max("size").alias("size"))
        .join(taught, "id").withColumn("turn", F.xxhash64("id"))
    )
    chosen = {}
    for label in (0, 1):
        rows = known.where(F.col("label") == label).orderBy("turn", "id").limit(per_class).collect()
        chosen |= {r.id: label for r in rows}
    if not chosen:
        return fit([], np.zeros(0))
    found = (
        docs.select(key.alias("id"), F.col(text_col).cast("binary").alias("text"))
        .where(F.col("id").isin(list(chosen)) & F.octet_length("text").between(1, longest))
        .groupBy("id").agg(F.min("text").alias("text"))
        .orderBy("id").collect()
    )
    return fit([bytes(r.text) for r in found], np.array([chosen[r.id] for r in found], np.float32))


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) % 3 == 1


def scored(
    docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: id and ``score`` between 0 and 1."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text", 2 << 20):
            texts = [t or b"" for t in block.column("text").to_pylist()]
            scores = pa.array(score_texts(net, texts), pa.float64())
            yield pa.RecordBatch.from_arrays([block.column("id"), scores], names=["doc_id", "score"])

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(score, "doc_id long, score double")


def quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **learning: int | str
) -> DataFrame:
    """Score every document with a network learned from the labels that are not held out."""
    net = learned(docs, labels, id_col=id_col, text_col=text_col, **learning)
    out = scored(docs, net, id_col, text_col)
    return out.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
