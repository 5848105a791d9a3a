"""Packing tokenised documents into windows of a fixed number of tokens.

A document is its token ids and an end id.  It is cut at multiples of the
capacity; whole pieces fill a window alone, the remainders are packed by
multiway differencing (Karmarkar and Karp): every remainder starts as a partial
partition that loads one of k windows; the two partial partitions with the
largest imbalance are merged, heavy windows of one with light windows of the
other, until one is left.  Windows come out nearly equal; where the heaviest
exceeds the capacity, the number of windows rises and the differencing starts
again.

Remainders are dealt into groups of bounded size by a hash of the row, so no
task holds more than a group, and a group of copies is spread like any other.

Defined cases: null or empty text is the end id alone; a repeated row is a
document of its own; rows with null id are packed too; an empty table gives no
pieces; other columns are not read.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import Recent, materialise, split_count, text_blocks

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, slot long"
)
PACKED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " sequence_id long, offset long"
)
GROUP_ITEMS = 2048
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII without the apostrophe, which starts contractions
_PLAIN = rf"^(?P<core>[A-Za-z]+)(?P<tail>[{re.escape(_MARKS)}]*)$"


def _gathered(values: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` (one after the other, of ``sizes``) that are ``chosen``, in that order."""
    taken = sizes[chosen]
    begin = (np.cumsum(sizes) - sizes)[chosen]
    return values[np.repeat(begin - (np.cumsum(taken) - taken), taken) + np.arange(int(taken.sum()))]


class WordIds:
    """Token ids of texts as little-endian bytes, encoding each distinct word once.

    For lower-casing tokenizers that drop white space, never join across it and
    end the last token of a piece with a suffix: a text's ids are those of its
    words in turn.  Words of letters, also with ASCII marks behind them, are
    encoded many at a time and told apart by the suffix; other words, such as those
    that spell an added token, go by their offsets.  ASCII words are cut into letters and
    marks, which are looked up apart, for all words of a block at once.  The stores of words have two
    generations, so their memory is bounded and frequent words stay.
    """

    def __init__(self, tokenizer, suffix: str, most: int = 200_000, longest: int = 64):
        self._tokenizer, self._longest = tokenizer, longest
        vocabulary = tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._known, self._cores = Recent(most // 2), Recent(most)

    def _short(self, word: str) -> bool:
        return len(word) <= self._longest

    def _letters(self, cores: list[str]) -> list[bytes]:
        """Ids of words that are one piece each."""
        out = []
        for i in range(0, len(cores), 2000):
            part = cores[i : i + 2000]
            coded = self._tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0]
            ids = np.asarray(coded.ids, "<u4")
            stops = np.flatnonzero(self._ends[ids]) + 1
            if len(stops) != len(part):
                out += self._by_offset(part)
                continue
            raw, to = ids.tobytes(), (4 * stops).tolist()
            out += [raw[x:y] for x, y in zip([0, *to], to)]
        return out

    def _by_offset(self, words: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(words), 1000):
            part = words[i : i + 1000]
            coded = self._tokenizer.encode(" ".join(part), add_special_tokens=False)
            starts = np.array([o[0] for o in coded.offsets], np.int64)
            to = (4 * np.searchsorted(starts, np.cumsum([len(w) + 1 for w in part]))).tolist()
            raw = np.asarray(coded.ids, "<u4").tobytes()
            out += [raw[x:y] for x, y in zip([0, *to], to)]
        return out

    def _learn(self, words: list[str]) -> list[bytes]:
        whole, lows, tails, odd = [], [], [], []
        for place, word in enumerate(words):
            core = word.rstrip(_MARKS)
            low = core.lower()
            # A capital sigma at the end of a word is lowered in another way by the tokenizer.
            if low.isalpha() and (low.isascii() or ("\u03a3" not in core and is_normalized("NFC", low))):
                whole.append(place)
                lows.append(low)
                tails.append(word[len(core) :])
            elif word:
                odd.append(place)
        heads, ends = list(set(lows)), [t for t in set(tails) if t]
        core_of = dict(zip(heads, self._cores.values(heads, self._letters, self._short)))
        tail_of = dict(zip(ends, self._cores.values(ends, self._by_offset, self._short))) | {"": b""}
        out = [b""] * len(words)
        for place, low, tail in zip(whole, lows, tails):
            out[place] = core_of[low] + tail_of[tail]
        for place, ids in zip(odd, self._by_offset([words[i] for i in odd])):
            out[place] = ids
        return out

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text ends."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary
        parts = pc.extract_regex(words, _PLAIN)
        plain = parts.is_valid()
        cores = pc.ascii_lower(parts.filter(plain).field(0)).dictionary_encode()
        tails = parts.filter(plain).field(1).dictionary_encode()
        found = self._cores.values(cores.dictionary.to_pylist(), self._letters, self._short)
        marks = [t for t in tails.dictionary.to_pylist() if t]
        mark_of = dict(zip(marks, self._cores.values(marks, self._by_offset, self._short))) | {"": b""}
        kinds = [found, [mark_of[t] for t in tails.dictionary.to_pylist()]]
        kinds.append(self._known.values(words.filter(pc.invert(plain)).to_pylist(), self._learn, self._short) + [b""])
        pool = np.frombuffer(b"".join(chain.from_iterable(kinds)), "<u4")
        sizes = np.fromiter(map(len, chain.from_iterable(kinds)), np.int64) // 4
        # Of each distinct word the places in the pool of its letters and marks, or of the whole word and of nothing.
        plain = plain.to_numpy(zero_copy_only=False)
        held = np.full((len(words), 2), len(sizes) - 1)
        held[plain, 0] = cores.indices.to_numpy()
        held[plain, 1] = tails.indices.to_numpy() + len(kinds[0])
        held[~plain, 0] = np.arange(len(kinds[2]) - 1) + len(kinds[0]) + len(kinds[1])
        flat = _gathered(pool, sizes, held.ravel())
        length = sizes[held].sum(axis=1)
        place = coded.indices.to_numpy()
        taken = length[place]
        stops = np.cumsum(taken)
        start = (np.cumsum(length) - length)[place]
        ids = flat[np.repeat(start - (stops - taken), taken) + np.arange(stops[-1] if len(stops) else 0)]
        return ids, np.r_[0, stops][lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()]


@lru_cache(maxsize=1)
def tokenizer_words(path: str, suffix: str = "</w>") -> WordIds:
    """One store per Python worker, kept from task to task."""
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.model._resize_cache(0)  # words are kept here
    return WordIds(tokenizer, suffix)


def cut_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of documents; ``slot`` numbers the pieces within the run."""
    end = np.asarray([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer_words(tokenizer_path)
        slot = TaskContext.get().partitionId() << 36
        for block in text_blocks(batches, "text"):
            rows = []
            ids, stops = words.of(block.column("text"))
            raw, at = ids.tobytes(), 0
            for doc, stop in zip(block.column("id").to_pylist(), (4 * stops).tolist()):
                ids, at = raw[at:stop] + end, stop
                tokens = len(ids) // 4
                for start in range(0, tokens, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc, start, len(part) // 4, zlib.crc32(part), tokens, slot))
                    slot += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "slot"],
            )

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(cut, PIECES)


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """Window of each item: multiway differencing of ``sizes`` into ``k`` windows."""
    n = len(sizes)
    if n == 0 or k == 1:
        return np.zeros(n, np.int64)
    # Loads are kept in falling order, less their minimum.
    loads = {i: np.r_[sizes[i], np.zeros(k - 1, np.int64)] for i in range(n)}
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    parents: list[tuple[int, int, np.ndarray]] = []
    node = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = loads.pop(a) + loads.pop(b)[::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order]
        total -= total[-1]
        loads[node] = total
        parents.append((a, b, order))
        heapq.heappush(heap, (-int(total[0]), node))
        node += 1
    # From the root down: place r of a merge holds place order[r] of its first
    # part and the mirrored place of its second part.
    places = {node - 1: np.arange(k)}
    window = np.zeros(n, np.int64)
    if n == 1:
        return window
    for at in range(len(parents) - 1, -1, -1):
        a, b, order = parents[at]
        names = np.empty(k, np.int64)
        names[order] = places.pop(n + at)
        for part, held in ((a, names), (b, names[::-1])):
            if part < n:
                window[part] = held[0]
            else:
                places[part] = held
    return window


def windows_of(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Windows for items of at most ``capacity``, none above it."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, k)
        heaviest = int(np.bincount(window, weights=sizes, minlength=k).max())
        if heaviest <= capacity:
            return window
        # The excess of the heaviest window, spread over all, asks for about this many more.
        k += max(1, int(k * (heaviest - capacity) / capacity / 3))


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 2,
    id_col: str = "doc_id", text_col: str = "text", group_items: int = GROUP_ITEMS,
) -> DataFrame:
    """Every piece of every document with its sequence and its offset there."""
    pieces = materialise(
        cut_documents(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces"
    )
    whole = pieces.where(F.col("length") == capacity)
    rest = pieces.where(F.col("length") < capacity)
    groups = split_count(rest.count(), group_items)

    def arrange(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("slot", "ascending")])
        sizes = table.column("length").to_numpy()
        window = windows_of(sizes, capacity)
        order = np.argsort(window, kind="stable")
        before = np.cumsum(sizes[order]) - sizes[order]
        first = np.searchsorted(window[order], np.arange(window.max() + 1))
        offset = np.empty(len(sizes), np.int64)
        offset[order] = before - before[first][window[order]]
        group = table.column("pack_group")[0].as_py()
        ids = ((np.int64(group) << 24) | window) << 1
        kept = table.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        return kept.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offset))

    packed = (
        rest.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "slot"), F.lit(groups)))
        .groupBy("pack_group")
        .applyInArrow(arrange, PACKED)
    )
    alone = whole.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("slot") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    return alone.unionByName(packed)
