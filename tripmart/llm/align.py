"""Alignment of the tokens of two tokenizers, and how often each pair of ids is linked.

A text is encoded by a byte-level tokenizer A (with a space in front) and a piece
tokenizer B.  Byte offsets where tokens of both end cut the tokens into groups;
all pairs of an A and a B token of one group are links.  A pair's count is the
number of documents that hold it linked.

Both tokenizers never join across a single space between two characters that
are no white space, so documents are cut there into units, and each distinct unit is
encoded and aligned once.  Counting has a fast path: an array maps every A id to
the B id with the same bytes, and links of such two ids (the one-to-one groups)
are counted in a vector of vocabulary length per task.  Only the other pairs are
shuffled: each chunk of documents sends its distinct ones with their number of documents,
a window over the pair adds them up, and the sums go back to the chunk.  A pair thus
has one row per chunk at most, however many documents hold it.

Per A id, the highest count and that of its same-bytes partner are two vectors of
vocabulary length, so they can be sent to all tasks.

Defined cases: null and empty texts have no tokens, nor have texts whose tokens
of either side do not give back the bytes of space and text (such as texts with U+2581, which B
takes for a space); strings of special tokens are plain text; every row is a
document, repeated ones too; null ids are kept; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import Recent, materialise, text_blocks

_DOUBLE = re.compile(r"\s\s")
_GAP = re.compile(r"(?<=\S) (?=\S)")
_SPACES = r"[\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ODD = f"{_SPACES} | {_SPACES}|^ | $"
_LARGE_GROUP = 4096  # links in one group above which equal ids are put together first
STORED = (
    "kind int, chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " units array<int>, keys array<long>, docs array<int>, refs array<int>, times array<long>, sizes array<int>, vector binary"
)
ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
_NAMES = [part.split()[0] for part in STORED.split(", ")]
_TYPES = {
    "int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
}
_FIELDS = pa.schema([(part.split()[0], _TYPES[part.split()[1]]) for part in STORED.split(", ")])


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def units_of(text: str) -> list[str]:
    """Stretches of space and text that both tokenizers encode apart, each with a space in front."""
    return [f" {part}" for part in _GAP.split(text)] if text else []


def _taken(values: pa.Array, places: np.ndarray) -> bytes:
    """The chosen texts, one behind the other."""
    if not len(places):
        return b""
    _, stops, data = values.take(pa.array(places)).buffers()
    width = np.int64 if values.type == pa.large_string() else np.int32
    return data.to_pybytes()[: np.frombuffer(stops, width)[len(places)]]


class Aligner:
    """Both tokenizers, the identity map and the alignment of units."""

    def __init__(self, path_a: str, path_b: str, most: int = 60_000, longest: int = 48):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.model._resize_cache(0)  # units are kept here
        self.b = SentencePieceProcessor(model_file=path_b)
        letters, vocabulary = byte_letters(), self.a.get_vocab()
        self.raw_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.raw_a[i] = bytes(letters[c] for c in token)
        self.raw_b = [self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        for i in range(len(self.raw_b)):
            if self.b.is_byte(i):
                self.raw_b[i] = bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        # Of B ids with the same bytes a piece goes before a byte.
        named: dict[bytes, int] = {}
        for i in sorted(range(len(self.raw_b)), key=lambda i: (self.b.is_byte(i), i)):
            if not (self.b.is_control(i) or self.b.is_unknown(i)):
                named.setdefault(self.raw_b[i], i)
        self.same = np.array([named.get(raw, -1) if raw else -1 for raw in self.raw_a], np.int64)
        self._size_a, self._size_b = (np.array([len(r) for r in raws], np.int64) for raws in (self.raw_a, self.raw_b))
        self._raws = [pa.array(raws, pa.binary()) for raws in (self.raw_a, self.raw_b)]
        # Ids as text with the sign behind them: A ids within a group and at its end, B ids also at the end of a unit.
        signs = [(self.raw_a, ",|"), (self.raw_b, ",;\n")]
        self._names = pa.array([f"{i}{sign}" for raws, marks in signs for sign in marks for i in range(len(raws))])
        self._units, self._longest = Recent(most), longest

    def units(self, units: list[str]) -> list[tuple]:
        """Per distinct unit: numbers of A tokens, B tokens, groups and links; pairs and their times as bytes (empty: once each); its groups as text.

        A unit whose bytes do not come back has -1 A tokens.
        """
        return self._units.values(units, self._solve, lambda unit: len(unit) <= self._longest)

    def _solve(self, units: list[str]) -> list[tuple]:
        out = []
        for i in range(0, len(units), 8_000):
            out += self._aligned(units[i : i + 8_000])
        return out

    def _joined(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """A and B ids of all units, in turn: 50 units go as one text, unless white space at an end of one would join it to the next."""
        texts = []
        for i in range(0, len(units), 50):
            run = "".join(units[i : i + 50])
            texts += units[i : i + 50] if _DOUBLE.search(run) else [run]
        return self._coded_a(texts), self.b.encode([t[1:] for t in texts], num_threads=1)

    def _coded_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def _aligned(self, units: list[str]) -> list[tuple]:
        raws = [u.encode() for u in units]
        whole = b"".join(raws)
        a, b = (np.fromiter(chain.from_iterable(coded), np.int64) for coded in self._joined(units))
        if _taken(self._raws[0], a) != whole or _taken(self._raws[1], b) != whole:
            coded_a, coded_b = self._coded_a(units), self.b.encode([u[1:] for u in units], num_threads=1)
            good = [
                b"".join(map(self.raw_a.__getitem__, x)) == raw == b"".join(map(self.raw_b.__getitem__, y))
                for raw, x, y in zip(raws, coded_a, coded_b)
            ]
            solved = iter(self._aligned([u for u, fine in zip(units, good) if fine]) if any(good) else ())
            return [next(solved) if fine else (-1, 0, 0, 0, b"", b"", "") for fine in good]

        end_a, end_b = np.cumsum(self._size_a[a]), np.cumsum(self._size_b[b])
        stops = np.cumsum([len(r) for r in raws])
        count_a, count_b = (np.diff(np.searchsorted(end, stops, "right"), prepend=0) for end in (end_a, end_b))
        ends = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        in_a, in_b = (np.bincount(g, minlength=len(ends)) for g in (group_a, group_b))
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        of_unit = np.searchsorted(stops, ends)

        # Links of usual groups one by one, those of very large ones by distinct ids.
        large = in_a * in_b > _LARGE_GROUP
        per_a = np.where(large[group_a], 0, in_b[group_a])
        left = np.repeat(np.arange(len(a)), per_a)
        right = first_b[group_a[left]] + np.arange(len(left)) - (np.cumsum(per_a) - per_a)[left]
        keys, times, owner = a[left] << 32 | b[right], np.ones(len(left), np.int64), of_unit[group_a[left]]
        for g in np.flatnonzero(large).tolist():
            x, n = np.unique(a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
            y, m = np.unique(b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
            keys = np.concatenate([keys, (x[:, None] << 32 | y[None]).ravel()])
            times = np.concatenate([times, (n[:, None] * m[None]).ravel()])
            owner = np.concatenate([owner, np.full(len(x) * len(y), of_unit[g])])
        if large.any():
            order = np.argsort(owner, kind="stable")
            keys, times, owner = keys[order], times[order], owner[order]
        held = (8 * np.searchsorted(owner, np.arange(len(units) + 1))).tolist()
        key_bytes, time_bytes = keys.tobytes(), times.tobytes()
        once = np.bincount(owner, weights=times - 1, minlength=len(units)) == 0

        # The groups as text: A ids, then B ids, with a line end behind each unit.
        names = np.empty(len(a) + len(b), np.int64)
        last_a = np.arange(len(a)) == (first_a + in_a - 1)[group_a]
        last_b = (np.arange(len(b)) == (first_b + in_b - 1)[group_b]).astype(np.int64)
        last_b[np.cumsum(count_b) - 1] = 2
        names[np.arange(len(a)) + first_b[group_a]] = a + last_a * len(self.raw_a)
        names[np.arange(len(b)) + first_a[group_b] + in_a[group_b]] = 2 * len(self.raw_a) + b + last_b * len(self.raw_b)
        texts = _taken(self._names, names).decode().split("\n")
        groups = np.bincount(of_unit, minlength=len(units))
        links = np.bincount(of_unit, weights=in_a * in_b, minlength=len(units)).astype(np.int64)
        return [
            (x, y, g, n, key_bytes[s:e], b"" if one else time_bytes[s:e], text)
            for x, y, g, n, s, e, one, text in zip(
                count_a.tolist(), count_b.tolist(), groups.tolist(), links.tolist(), held, held[1:], once.tolist(), texts
            )
        ]


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per Python worker, kept from task to task."""
    return Aligner(path_a, path_b)


def _unit_lists(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct units of all texts, the units of each text in turn, and where each text ends."""
    texts = pc.fill_null(texts, "")
    odd = pc.and_(pc.match_substring_regex(texts, _ODD), pc.greater(pc.binary_length(texts), 0)).to_numpy(zero_copy_only=False)
    plain = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
    words = pa.concat_arrays([plain.flatten(), pa.array([p for t in texts.filter(pa.array(odd)).to_pylist() for p in _GAP.split(t)], pa.string())])
    coded = words.dictionary_encode()
    places = coded.indices.to_numpy()
    sizes = np.empty(len(texts), np.int64)
    sizes[~odd] = pc.list_value_length(plain).to_numpy(zero_copy_only=False)
    sizes[odd] = [len(_GAP.split(t)) for t in texts.filter(pa.array(odd)).to_pylist()]
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    if odd.any():
        # Odd texts were put behind the plain ones: back in turn.
        begin = np.empty(len(texts), np.int64)
        order = np.r_[np.flatnonzero(~odd), np.flatnonzero(odd)]
        begin[order] = np.cumsum(sizes[order]) - sizes[order]
        places = places[np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
    if empty.any():
        places = places[~np.repeat(empty, sizes)]
        sizes[empty] = 0
    return pc.binary_join_element_wise("", coded.dictionary, " ").to_pylist(), places, np.cumsum(sizes)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches."""
    stops = np.cumsum(sizes)
    total = np.r_[0, np.cumsum(values)]
    return total[stops] - total[stops - sizes]


def _gathered(values: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` (one after the other, of ``sizes``) that are ``chosen``, in that order."""
    taken = sizes[chosen]
    begin = (np.cumsum(sizes) - sizes)[chosen]
    return values[np.repeat(begin - (np.cumsum(taken) - taken), taken) + np.arange(int(taken.sum()))]


def _batch(**columns: pa.Array) -> pa.RecordBatch:
    rows = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(rows, f.type)).cast(f.type) for f in _FIELDS], schema=_FIELDS)


def encoded(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = 1 << 20) -> DataFrame:
    """Stored rows of three kinds: documents (0), chunks with their distinct pairs (1), a task's vector of same-bytes pairs (2)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = aligner(path_a, path_b)
        chunk = TaskContext.get().partitionId() << 33
        vector = np.zeros(len(model.raw_a), np.int64)
        for block in text_blocks(batches, "text", chunk_bytes):
            units, places, stops = _unit_lists(block.column("text"))
            found = model.units(units)
            counts = np.array([f[:4] for f in found], np.int64).reshape(len(found), 4)
            sizes = np.diff(stops, prepend=0)
            broken = _sums((counts[places, 0] < 0).astype(np.int64), sizes) > 0
            if broken.any():
                places = places[~np.repeat(broken, sizes)]
                sizes = np.where(broken, 0, sizes)
            stops = np.cumsum(sizes)
            numbers = [_sums(counts[places, j], sizes) for j in range(4)]
            texts = pa.array([f"{f[6]};" for f in found], pa.large_string())
            written, ends = _taken(texts, places), np.cumsum(pc.binary_length(texts).to_numpy()[places])
            shas, begin = [], 0
            for stop, some in zip(stops.tolist(), (sizes > 0).tolist()):
                end = int(ends[stop - 1]) if some else begin
                shas.append(hashlib.sha256(written[begin : end - 1]).hexdigest() if some else "")
                begin = end
            yield _batch(
                kind=pa.array(np.zeros(len(sizes), np.int32)), chunk=pa.array(np.full(len(sizes), chunk)), doc_id=block.column("doc_id"),
                n_a=pa.array(numbers[0]), n_b=pa.array(numbers[1]), n_groups=pa.array(numbers[2]), n_links=pa.array(numbers[3]),
                groups_sha256=pa.array(shas, pa.string()),
                units=pa.ListArray.from_arrays(pa.array(np.r_[0, stops].astype(np.int32)), pa.array(places.astype(np.int32))),
            )

            # Links of the units, and in how many documents each distinct pair is.
            links = np.frombuffer(b"".join([f[4] for f in found]), np.int64)
            held = np.array([len(f[4]) for f in found], np.int64) // 8
            times, before = np.ones(len(links), np.int64), np.cumsum(held) - held
            for i in [i for i, f in enumerate(found) if f[5]]:
                times[before[i] : before[i] + held[i]] = np.frombuffer(found[i][5], np.int64)
            keys, refs = np.unique(links, return_inverse=True)
            owner = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
            seen = np.unique(owner * max(1, len(found)) + places)  # distinct units of each document
            owner, unit = seen // max(1, len(found)), seen % max(1, len(found))
            pairs = np.unique(np.repeat(owner, held[unit]) * max(1, len(keys)) + _gathered(refs, held, unit))
            docs_of = np.bincount(pairs % max(1, len(keys)), minlength=len(keys))
            same = model.same[keys >> 32] == keys & 0xFFFFFFFF
            vector[keys[same] >> 32] += docs_of[same]
            lists = {
                "keys": keys, "docs": np.where(same, 0, docs_of).astype(np.int32), "refs": refs.astype(np.int32), "times": times,
                "sizes": held.astype(np.int32),
            }
            yield _batch(
                kind=pa.array([1]), chunk=pa.array([chunk]),
                **{k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v)) for k, v in lists.items()},
            )
            chunk += 1
        if vector.any():
            yield _batch(kind=pa.array([2]), vector=pa.array([vector.tobytes()], pa.binary()))

    return materialise(docs.mapInArrow(encode, STORED), "encoded")


def same_bytes_counts(stored: DataFrame, width: int) -> DataFrame:
    """a, docs: the tasks' vectors added up."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            for held in batch.column("vector"):
                total += np.frombuffer(held.as_buffer(), np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["a", "docs"])

    vectors = stored.where("kind = 2").select("vector")
    return vectors.mapInArrow(add, "a long, docs long").groupBy("a").agg(F.sum("docs").alias("docs"))


def pair_counts(stored: DataFrame) -> DataFrame:
    """chunk, pair, docs: the pairs of each chunk that are not of the same bytes, with their number of documents in all chunks."""
    held = stored.where("kind = 1").select("chunk", F.explode(F.arrays_zip("keys", "docs")).alias("p"))
    part = held.select("chunk", F.col("p.keys").alias("pair"), F.col("p.docs").cast("long").alias("docs")).where("docs > 0")
    return part.select("chunk", "pair", F.expr("sum(docs) OVER (PARTITION BY pair)").alias("docs"))


def align(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = 1 << 20
) -> DataFrame:
    """Per document: numbers of tokens, groups and links; links that are the most frequent of their A id; summed counts; digest of the groups."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    stored = encoded(narrow, path_a, path_b, chunk_bytes)
    model = aligner(path_a, path_b)
    width = len(model.raw_a)
    counts = materialise(pair_counts(stored), "pairs")

    # Two vectors of vocabulary length: documents of the same-bytes pair, and the highest count per A id.
    same, best = np.zeros(width, np.int64), np.zeros(width, np.int64)
    for r in same_bytes_counts(stored, width).collect():
        same[r.a] = best[r.a] = r.docs
    for r in counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("docs").alias("docs")).collect():
        best[r.a] = max(best[r.a], r.docs)
    sent = stored.sparkSession.sparkContext.broadcast((model.same, same, best))

    def finish(rows: pa.Table, told: pa.Table) -> pa.Table:
        partner, same, best = sent.value
        kind = rows.column("kind").to_numpy()
        head = rows.slice(int(np.flatnonzero(kind == 1)[0]), 1)
        keys, refs, times, sizes = (head.column(c).combine_chunks().flatten().to_numpy() for c in ("keys", "refs", "times", "sizes"))
        a = keys >> 32
        held = np.where(partner[a] == keys & 0xFFFFFFFF, same[a], 0)
        held[np.searchsorted(keys, told.column("pair").to_numpy())] = told.column("docs").to_numpy()
        top = held == best[a]
        unit_sum, unit_top = _sums(times * held[refs], sizes), _sums(times * top[refs], sizes)
        own = rows.filter(pa.array(kind == 0))
        units = own.column("units").combine_chunks()
        places, sizes = units.flatten().to_numpy(), pc.list_value_length(units).to_numpy()
        named = {name: own.column(name) for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table({
            **named, "n_best": pa.array(_sums(unit_top[places], sizes)), "count_sum": pa.array(_sums(unit_sum[places], sizes)),
            "groups_sha256": own.column("groups_sha256"),
        })

    rows = stored.where("kind < 2").drop("docs", "vector")
    return rows.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(finish, ALIGNED)
