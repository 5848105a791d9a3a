"""Collocations: phrases that occur more often than their parts suggest, per language.

Counts of all phrases of up to four words come from suffix trees truncated at that
depth, built by vertical partitioning as in ERA (Mansour, Allam, Skiadopoulos and
Kalnis, 2011).  A word's suffix is the word and up to three that follow it in its piece.
Suffixes are divided by prefixes: two words whose suffixes would exceed the memory
budget are extended by the next word, and three such words again, until every prefix is
small enough; prefixes are then grouped, by a histogram over their hashes, into
groups of about the budget.  Every chunk of texts sends its distinct suffixes, with
their number, to the group of their prefix.  A group sorts them, which is its
subtrees side by side, and reads the count of each node from the totals of the
leaves below it.  Counts of the prefixes that were extended are known from dividing.

The budget grows with the corpus once there would be more than ``MOST_GROUPS``
groups, so extended prefixes, of which each takes more than a budget of suffixes,
can be sent to all tasks.  A suffix ends where two neighbours are too rare for any candidate: hashes of
neighbours are counted first, which gives the sizes of the shortest prefixes too, and bit
tables of bounded size tell which words and which two neighbours may be frequent
(a wrong yes costs shuffle only).

Words are told apart by 64-bit hashes of language and word; the table of words is searched for
two words with one hash, and if there are any, all is done with other hashes.

The rest is relational: a phrase is joined to the phrase behind its first word,
which brings the counts of all of its ends and its text.

Defined cases: A to Z count as lower case; null text has no words, null language is ``und``
(and one with rows of that name); every row is a text, repeated ones too; a language without candidates gives no
rows, an empty table none; ids and other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import materialise, text_blocks
from tripmart.llm.grams import _LOWER, byte_values, mixed, word_spans

DEPTH = 4
MOST_GROUPS = 1 << 20
MOST_BITS = 26
BLOCK_BYTES = 3 << 20
_KEYS = ["k1", "k2", "k3", "k4"]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BETWEEN = np.zeros(256, bool)  # ends a piece
_BETWEEN[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WHITE = _BETWEEN.copy()
_WHITE[[0x20, 0x09]] = True
_PAIR = np.uint64(0xFFFFFFFFFF000000)  # what is kept of the hash of two neighbours
NODES = "k1 long, k2 long, k3 long, k4 long, f long, l2 long, l3 long"


@dataclass
class Words:
    """Words of a block in turn: keys, piece numbers, places of their bytes, and the language of each."""

    keys: np.ndarray
    piece: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    raw: np.ndarray
    lang: np.ndarray
    langs: list[str]


def words_of(block: pa.RecordBatch, seed: int) -> Words:
    hashes, begins, ends, raw, offsets = word_spans(block.column("text"), _WHITE, byte_values(seed))
    coded = block.column("lang").dictionary_encode()
    langs = coded.dictionary.to_pylist()
    salts = np.array(
        [int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little") for name in langs], np.uint64
    )
    text = np.searchsorted(offsets[1:], begins, "right")
    lang = coded.indices.to_numpy()[text].astype(np.int64)
    keys = mixed(hashes ^ salts[lang]) if len(hashes) else hashes
    keys[keys == 0] = 1
    # A piece ends at a separator or with its text.
    marks = np.flatnonzero(_BETWEEN[raw])
    piece = np.searchsorted(marks, begins) + text
    return Words(keys, piece, begins, ends, raw, lang, langs)


def _prefix_hashes(keys: np.ndarray) -> list[np.ndarray]:
    """Hash of the first 1, 2, ... keys of each row."""
    out = [keys[0]]
    for k in keys[1:]:
        out.append(mixed(out[-1] * _STEP + k))
    return out


def _within(held: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes are among the sorted ones held."""
    if not len(held):
        return np.zeros(len(hashes), bool)
    return held[np.minimum(np.searchsorted(held, hashes), len(held) - 1)] == hashes


def _combined(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of ``keys`` and how often each occurs."""
    name = _prefix_hashes(keys)[-1]
    order = np.argsort(name, kind="stable")
    keys, name = keys[:, order], name[order]
    new = np.r_[True, name[1:] != name[:-1]] if len(name) else np.zeros(0, bool)
    if (keys[:, 1:] != keys[:, :-1]).any(axis=0)[~new[1:]].any():  # two columns with one hash
        order = np.lexsort(keys[::-1])
        keys = keys[:, order]
        new = np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]
    starts = np.flatnonzero(new)
    return keys[:, starts], np.diff(np.r_[starts, keys.shape[1]])


@dataclass
class Bits:
    """A bit for each value of the first bits of a hash."""

    table: np.ndarray
    log_bits: int

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.log_bits)
        return (self.table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


@dataclass
class Division:
    """How suffixes are divided: extended prefixes by length, and the group of each hash range."""

    seed: int
    words: Bits
    pairs: Bits | None = None
    large: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # kept hashes of neighbours above the budget
    heavy: dict[int, np.ndarray] = field(default_factory=dict)  # by length, sorted hashes of extended prefixes
    counts: dict[int, np.ndarray] = field(default_factory=dict)  # and their counts
    group: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))

    def extended(self, level: int, hashes: np.ndarray) -> np.ndarray:
        """Which prefixes of ``level`` words are extended."""
        return _within(self.heavy.get(level, hashes[:0]), hashes)

    def count(self, level: int, hashes: np.ndarray) -> np.ndarray:
        """Counts of extended prefixes; any number for others."""
        held = self.heavy.get(level)
        if held is None or not len(held):
            return np.zeros(len(hashes), np.int64)
        return self.counts[level][np.minimum(np.searchsorted(held, hashes), len(held) - 1)]

    def neighbours(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places whose word and the next of its piece may both be frequent, and the hashes of the two."""
        fine = self.words.has(words.keys)
        at = np.flatnonzero(fine[:-1] & fine[1:] & (words.piece[:-1] == words.piece[1:]))
        return at, mixed(words.keys[at] * _STEP + words.keys[at + 1]) & _PAIR

    def suffixes(self, words: Words) -> np.ndarray:
        """Keys of the suffixes of two and more words, zeros behind their ends."""
        at, pairs = self.neighbours(words)
        at = at[self.pairs.has(pairs)]
        goes_on = np.zeros(len(words.keys) + DEPTH, bool)
        goes_on[at] = True
        out = np.zeros((DEPTH, len(at)), np.uint64)
        out[0], out[1] = words.keys[at], words.keys[at + 1]
        there = np.ones(len(at), bool)
        for j in range(2, DEPTH):
            there &= goes_on[at + j - 1]
            out[j, there] = words.keys[at[there] + j]
        return out

    def group_of(self, hashes: np.ndarray) -> np.ndarray:
        shift = 64 - (len(self.group).bit_length() - 1)
        return self.group[(hashes >> np.uint64(shift)).astype(np.int64)] if shift < 64 else np.zeros(len(hashes), np.int32)


def _narrow(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang")
    )


def word_table(texts: DataFrame, least: int, seed: int) -> DataFrame:
    """key, lang, word, n of words with ``least`` occurrences, and the empty word with the number of all words of a language.

    ``names`` above 1 says that a key belongs to several words; these are all there.
    """

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            w = words_of(block, seed)
            keys, first, counts = np.unique(w.keys, return_index=True, return_counts=True)
            low = _LOWER[w.raw].tobytes()
            begins, ends = w.begins[first].tolist(), (w.ends[first] + 1).tolist()
            totals = np.bincount(w.lang, minlength=len(w.langs)) if len(keys) else np.zeros(0, np.int64)
            held = np.flatnonzero(totals)
            langs = pa.DictionaryArray.from_arrays(pa.array(np.r_[w.lang[first], held].astype(np.int32)), pa.array(w.langs, pa.string()))
            whole = [int.from_bytes(hashlib.blake2b(w.langs[i].encode(), digest_size=8, key=b"all").digest(), "little", signed=True) for i in held]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(keys.view(np.int64)), pa.array(whole, pa.int64())]), langs.dictionary_decode(),
                    pa.array([low[a:b] for a, b in zip(begins, ends)] + [b""] * len(held), pa.binary()).cast(pa.string()),
                    pa.array(np.r_[counts, totals[held]].astype(np.int64)),
                ],
                names=["key", "lang", "word", "n"],
            )

    spelled = texts.mapInArrow(spell, "key long, lang string, word string, n long")
    # One shuffle by key, which serves the sums and the search for shared keys.
    per_word = spelled.repartition("key").groupBy("key", "lang", "word").agg(F.sum("n").alias("n"))
    named = per_word.withColumn("names", F.count("*").over(Window.partitionBy("key")))
    return materialise(named.where((F.col("n") >= least) | (F.col("word") == "") | (F.col("names") > 1)), "words")


def _bit_table(rows: DataFrame, count: int) -> Bits:
    """Bits of the hashes ``h``: their first bits, 8 places for each at least while the table is small."""
    log_bits = min(MOST_BITS, max(12, (8 * count).bit_length()))
    place = F.shiftrightunsigned("h", 64 - log_bits)
    told = rows.groupBy(F.shiftright(place, 6).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - log_bits}) & 63 as int))")).alias("bits")
    ).toArrow()
    table = np.zeros(1 << max(0, log_bits - 6), np.int64)
    table[told.column("at").to_numpy()] = told.column("bits").to_numpy()
    return Bits(table.view(np.uint8), log_bits)


def _pair_counts(texts: DataFrame, plan: Broadcast, least: int) -> DataFrame:
    """Hashes of neighbours with ``least`` occurrences, which are those of all frequent ones and few others."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        division = plan.value
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            found, n = np.unique(division.neighbours(words_of(block, division.seed))[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int32))], names=["h", "n"])

    counted = texts.mapInArrow(count, "h long, n int").groupBy("h").agg(F.sum("n").alias("n"))
    return materialise(counted.where(F.col("n") >= least), "neighbours")


def _level_table(texts: DataFrame, plan: Broadcast, level: int) -> DataFrame:
    """Prefixes one word longer than an extended prefix of ``level`` words (at 2, these too): keys, hash and count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        division = plan.value
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            keys = division.suffixes(words_of(block, division.seed))
            names = _prefix_hashes(keys)
            keys = keys[:, _within(division.large, names[1] & _PAIR)]
            if level > 2:
                keys = keys[:, division.extended(level, _prefix_hashes(keys)[level - 1])]
            parts = [keys[: level + 1, keys[level] != 0]] + ([keys[:2]] if level == 2 else [])
            for part in parts:
                part, counts = _combined(part)
                full = np.zeros((DEPTH, part.shape[1]), np.uint64)
                full[: len(part)] = part
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(k.view(np.int64)) for k in full), pa.array(_prefix_hashes(part)[-1].view(np.int64)), pa.array(counts.astype(np.int64))],
                    names=[*_KEYS, "h", "n"],
                )

    rows = texts.mapInArrow(count, "k1 long, k2 long, k3 long, k4 long, h long, n long")
    return materialise(rows.groupBy(*_KEYS, "h").agg(F.sum("n").alias("n")), f"prefixes-{level + 1}")


def _divided(texts: DataFrame, words: DataFrame, least: int, budget: int, seed: int) -> tuple[Division, list[DataFrame]] | None:
    """Extended prefixes, groups, and the tables of counted longer prefixes; None if two extended prefixes share a hash."""
    sc = texts.sparkSession.sparkContext
    frequent = words.where(F.col("word") != "").select(F.col("key").alias("h"))
    division = Division(seed, _bit_table(frequent, frequent.count()))
    often = _pair_counts(texts, sc.broadcast(division), least)
    total, count = often.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    division.pairs = _bit_table(often, count)
    budget = max(budget, -(-total // MOST_GROUPS))
    log_groups = min(MOST_GROUPS.bit_length() - 1, max(3, (8 * total // budget).bit_length()))
    load = np.zeros(1 << log_groups, np.int64)

    def loaded(rows: DataFrame) -> None:
        light = rows.where(F.col("n") <= budget).groupBy(F.shiftrightunsigned("h", 64 - log_groups).alias("at")).agg(F.sum("n").alias("n")).toArrow()
        load[light.column("at").to_numpy()] += light.column("n").to_numpy()

    def sorted_hashes(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        held = rows.select("h", "n").toArrow()
        hashes, counts = held.column("h").to_numpy().view(np.uint64), held.column("n").to_numpy()
        order = np.argsort(hashes)
        return hashes[order], counts[order]

    loaded(often)
    division.large = sorted_hashes(often.where(F.col("n") > budget))[0]
    tables = []
    if len(division.large):
        tables.append(_level_table(texts, sc.broadcast(division), 2))
        longer = tables[0].where("k3 <> 0")
        loaded(longer)
        for level, rows in ((2, tables[0].where("k3 = 0")), (3, longer.where(F.col("n") > budget))):
            division.heavy[level], division.counts[level] = sorted_hashes(rows)
            if (division.heavy[level][1:] == division.heavy[level][:-1]).any():
                return None
        if len(division.heavy[3]):
            same = longer.groupBy("h").agg(F.count("*").alias("rows"), F.max("n").alias("most"))
            if not same.where(f"rows > 1 AND most > {budget}").isEmpty():
                return None
            tables.append(_level_table(texts, sc.broadcast(division), 3))
    running = np.cumsum(load)
    division.group = (np.maximum(running - 1, 0) // budget).astype(np.int32)
    return division, tables


def _sent(texts: DataFrame, plan: Broadcast) -> DataFrame:
    """Distinct suffixes of each block with their number and the group of their prefix."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        division = plan.value
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            keys, counts = _combined(division.suffixes(words_of(block, division.seed)))
            # The hash of the shortest prefix that is not extended; what ends before it is counted already.
            names, goes = _prefix_hashes(keys), np.zeros(keys.shape[1], bool)
            chosen = names[1].copy()
            open_ = np.ones(keys.shape[1], bool)
            for level in range(2, DEPTH):
                there = open_ & (keys[level - 1] != 0)
                further = there & division.extended(level, names[level - 1])
                stays = there & ~further
                chosen[stays], goes[stays] = names[level - 1][stays], True
                open_ = further
            groups = division.group_of(chosen[goes])
            yield pa.RecordBatch.from_arrays(
                [pa.array(groups), *(pa.array(k[goes].view(np.int64)) for k in keys), pa.array(counts[goes].astype(np.int64))],
                names=["group", *_KEYS, "n"],
            )

    return texts.mapInArrow(send, "group int, k1 long, k2 long, k3 long, k4 long, n long")


def subtree_nodes(keys: np.ndarray, n: np.ndarray, division: Division, least: int) -> pa.RecordBatch:
    """Nodes of two or more words with ``least`` occurrences, of sorted suffixes; counts of their shorter prefixes beside them."""
    names = _prefix_hashes(keys)
    changed = np.zeros(keys.shape[1], bool)
    changed[:1] = True
    starts, totals, known = [], [], []
    for d in range(DEPTH):
        changed[1:] |= keys[d, 1:] != keys[d, :-1]
        first = np.flatnonzero(changed)
        whole = np.add.reduceat(n, first) if len(first) else n[:0]
        if 0 < d < DEPTH - 1:
            far = division.extended(d + 1, names[d][first])
            if d > 1:
                far &= known[-1][np.searchsorted(starts[-1], first, "right") - 1]
            whole = np.where(far, division.count(d + 1, names[d][first]), whole)
        else:
            far = np.zeros(len(first), bool)
        starts.append(first)
        totals.append(whole)
        known.append(far)
    columns = [[] for _ in range(7)]
    for d in range(1, DEPTH):
        good = (keys[d, starts[d]] != 0) & ~known[d] & (totals[d] >= least)
        first = starts[d][good]
        for j in range(DEPTH):
            columns[j].append(keys[j, first] if j <= d else np.zeros(len(first), np.uint64))
        columns[4].append(totals[d][good])
        for j in (1, 2):
            above = totals[j][np.searchsorted(starts[j], first, "right") - 1] if j < d else np.zeros(len(first), np.int64)
            columns[4 + j].append(above)
    flat = [np.concatenate(c) for c in columns]
    return pa.RecordBatch.from_arrays(
        [pa.array(c.view(np.int64)) for c in flat], names=[part.split()[0] for part in NODES.split(", ")]
    )


def _subtrees(plan: Broadcast, least: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        division = plan.value
        held, rows, wanted = [], 0, 100_000
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < wanted:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            keys = np.stack([table.column(k).to_numpy().view(np.uint64) for k in _KEYS])
            # What shares its prefix with the last suffix waits for the next batches.
            last, names = keys[:, -1], _prefix_hashes(keys[:, -1:])
            same = keys[0] == last[0]
            for level in range(2, DEPTH):
                same &= keys[level - 1] == last[level - 1]
                if not division.extended(level, names[level - 1])[0]:
                    break
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield subtree_nodes(keys[:, :cut], table.column("n").to_numpy()[:cut], division, least)
            held, rows = table.slice(cut).to_batches(), table.num_rows - cut
            wanted = max(100_000, 2 * rows)
        if rows:
            table = pa.Table.from_batches(held).combine_chunks()
            keys = np.stack([table.column(k).to_numpy().view(np.uint64) for k in _KEYS])
            yield subtree_nodes(keys, table.column("n").to_numpy(), division, least)

    return build


def _known_nodes(plan: Broadcast, least: int):
    """Nodes of prefixes that were counted while dividing: those extended, and whole phrases behind them."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        division = plan.value
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy().view(np.uint64) for k in _KEYS])
            n, names = batch.column("n").to_numpy(), _prefix_hashes(keys)
            depth = (keys != 0).sum(axis=0)
            far = np.zeros(len(n), bool)
            for level in range(2, DEPTH):
                here = depth == level
                far[here] = division.extended(level, names[level - 1][here])
            good = (n >= least) & (far | (depth == DEPTH))
            above = [np.where(depth > j, division.count(j, names[j - 1]), 0)[good] for j in (2, 3)]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(k[good].view(np.int64)) for k in keys), pa.array(n[good]), *(pa.array(a) for a in above)],
                names=[part.split()[0] for part in NODES.split(", ")],
            )

    return build


def phrase_counts(docs: DataFrame, least: int = 30, budget: int = 1 << 19, text_col: str = "text", lang_col: str = "lang", seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """Frequent words (key, lang, word, n) and phrases of 2 to 4 words: keys, f, and f of their first 2 and 3 words."""
    texts = _narrow(docs, text_col, lang_col)
    while True:
        words = word_table(texts, least, seed)
        if words.where("names > 1").isEmpty():
            divided = _divided(texts, words, least, budget, seed)
            if divided is not None:
                break
        seed += 1
    division, tables = divided
    plan = texts.sparkSession.sparkContext.broadcast(division)
    groups = int(division.group[-1]) + 1
    dealt = _sent(texts, plan).repartition(max(8, groups), "group").sortWithinPartitions(*_KEYS)
    nodes = dealt.drop("group").mapInArrow(_subtrees(plan, least), NODES)
    for table in tables:
        nodes = nodes.unionByName(table.select(*_KEYS, "n").mapInArrow(_known_nodes(plan, least), NODES))
    return words.drop("names"), materialise(nodes, "nodes")


def phrases(docs: DataFrame, least: int = 30, covered: int = 80, scale: int = 2_000_000, budget: int = 1 << 19, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """All candidates that no longer one covers: lang, phrase, a, l, r, cut, n, score.

    A candidate has ``least`` occurrences.  Its score is the smallest, over its
    cuts, of ``scale`` times a, divided by the sum of the counts of both parts, floored.
    A candidate of one word more that contains it covers it if it has ``covered`` percent
    of its occurrences; candidates longer still have no more than that one.
    """
    words, nodes = phrase_counts(docs, least, budget, text_col, lang_col)
    single = words.where("word <> ''").select("key", "lang", "word", F.col("n").alias("word_n"))
    named = nodes.join(single, nodes["k1"] == single["key"]).drop("key").withColumnRenamed("word_n", "l1")
    ends = single.select(F.col("key").alias("k2"), F.col("word").alias("rest"), F.col("word_n").alias("r1"))
    none = F.lit(0).cast("long")
    columns = [*_KEYS, "lang", "f", "l1", "l2", "l3", "r1", "r2", "r3", F.concat_ws(" ", "word", "rest").alias("phrase")]
    every = shorter = None
    for depth, own in ((2, "k3 = 0"), (3, "k3 <> 0 AND k4 = 0"), (4, "k4 <> 0")):
        if depth > 2:
            ends = shorter.select(
                *(F.col(_KEYS[j]).alias(_KEYS[j + 1]) for j in range(depth - 1)),
                F.col("phrase").alias("rest"), F.col("f").alias("r1"), F.col("r1").alias("r2"), F.col("r2").alias("r3"),
            )
        else:
            ends = ends.withColumns({"r2": none, "r3": none})
        shorter = materialise(named.where(own).join(ends, _KEYS[1:depth]).select(columns), f"phrases-{depth}")
        every = shorter if every is None else every.unionByName(shorter)

    longer = every.where("k3 <> 0").select(F.col("f").alias("longer"), F.inline(F.array(
        F.struct(F.col("k1").alias("k1"), F.col("k2").alias("k2"), F.when(F.col("k4") != 0, F.col("k3")).otherwise(F.lit(0)).alias("k3")),
        F.struct(F.col("k2").alias("k1"), F.col("k3").alias("k2"), F.col("k4").alias("k3")),
    ))).groupBy("k1", "k2", "k3").agg(F.max("longer").alias("longer")).withColumn("k4", F.lit(0).cast("long"))
    big = lambda c: f"cast({c} as decimal(20, 0))"
    kept = every.join(longer, _KEYS, "left").where(f"longer IS NULL OR 100 * {big('longer')} < {covered} * {big('f')}")
    cuts = [
        F.when(F.col(f"r{j}") > 0, F.struct(
            F.expr(f"({scale} * {big('f')}) div ({big(f'l{j}')} + {big(f'r{j}')})").alias("score"), F.lit(j).alias("cut"),
            F.col(f"l{j}").alias("l"), F.col(f"r{j}").alias("r"),
        )) for j in range(1, DEPTH)
    ]
    totals = words.where("word = ''").select("lang", "n")
    return (
        kept.withColumn("best", F.array_min(F.filter(F.array(*cuts), lambda c: c.isNotNull())))
        .join(totals, "lang")
        .select("lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", "best.cut", "n", "best.score")
    )


def collocations(docs: DataFrame, top: int = 2000, **options) -> DataFrame:
    """The first ``top`` phrases of each language by score, occurrences and text."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = phrases(docs, **options).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
