"""Exact Jaccard join of word n-gram sets by partition-and-enumerate signatures.

A document is the set of its distinct word n-grams.  Sets whose sizes allow the
wanted similarity meet in a size band; within a band, similarity bounds the
number of n-grams in which two sets differ.  The n-gram domain is split by hash into
first-level partitions, so that similar sets differ at most a few times in one of
them, and each of these into parts, of which all but so many are then equal: each
choice of these is a signature (PartEnum; Arasu, Ganti and Kaushik, 2006).  Similar
sets therefore share a signature; sharing one is verified on the sets.  A band in which
similar sets are equal has no signatures; where they differ once at most, they are the set
and the set without one n-gram.  A signature of parts without n-grams would be
shared by sets that have nothing in common: there are some more partitions than needed, so
that similar sets agree in as many more, and a set with no more empty partitions than that
leaves such signatures out.

Equal sets are one class from the start, and only classes take part in what
follows: their signatures are shuffled once, and those of one class alone end there.  First every class meets the smallest and the largest class of each of
its signatures (stars, so linear in the group).  Then classes that share a
signature and are still in different components meet each other, in blocks of
bounded size, so a signature of very many classes is spread over tasks.  Pairs
are only handed on if a parity sketch allows them: one bit per n-gram hash,
flipped by each n-gram, so two sets differ at least in as many n-grams as their
sketches in bits, and no similar pair is lost.  What is left is told apart in the same way by
sketches that grow with their set, and verified on the whole sets, for which only the texts concerned are read again.

Defined cases: a text with fewer words than ``n`` is one n-gram of all its
words; null, empty and blank texts have an empty set and link with nothing; a
repeated id is one document, in the component of all of its rows, and its size
is that of its largest set; rows with null id are left out; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from math import comb, exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import among, materialise, text_blocks, without
from tripmart.llm.components import components
from tripmart.llm.grams import chained, mixed, word_hashes

SETS = "doc_id long, n_shingles long, first long, second long, sketch array<long>"
BAND = 1.3
SKETCH_BITS = 1024
BLOCK = 1500


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    hashes, stops = word_hashes(texts)
    grams, out, start = chained(hashes, n), [], 0
    for stop in stops.tolist():
        if stop - start >= n:
            out.append(np.unique(grams[start : stop - n + 1]))
        elif stop > start:
            out.append(chained(hashes[start:stop], stop - start))
        else:
            out.append(grams[:0])
        start = stop
    return out


def bands(size: int) -> list[tuple[int, int]]:
    """Smallest and largest size of the bands from the first to the one of ``size``."""
    found, low = [], 1
    while not found or found[-1][1] < size:
        high = max(low, int(low * BAND))
        found.append((low, high))
        low = high + 1
    return found


def _band_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    limits = np.array(bands(int(sizes.max(initial=1)) * 2), np.int64)
    at = np.searchsorted(limits[:, 1], sizes)
    return at, limits[at, 1], np.append(limits[:, 0], 2**62)[at + 1]


def most_apart(size: np.ndarray, similarity: int) -> np.ndarray:
    """Most elements in which two sets up to ``size`` with that Jaccard similarity (percent) differ."""
    return 2 * size * (100 - similarity) // (100 + similarity)


@dataclass(frozen=True)
class Scheme:
    """First-level partitions, parts of each, how many parts may differ, and partitions beyond those needed."""

    partitions: int
    parts: int
    differ: int
    spare: int


@lru_cache(maxsize=4096)
def scheme_of(limit: int, apart: int) -> Scheme | None:
    """For sets up to ``limit`` that differ in up to ``apart`` n-grams: the smaller the sets, the more of their n-grams go into a signature."""
    if apart < 2:
        return None
    differ, parts = (apart, apart + 4) if apart < 4 else (3, 7) if apart < 8 else (4, 8) if apart < 10 else (2, 6) if apart < 24 else (1, 3)
    needed = apart // (differ + 1) + 1
    # Empty signatures of a set somewhat below the band, and what makes more than that unlikely.
    filled = 0.85 * limit / BAND / needed * (parts - differ) / parts
    empty = comb(parts, differ) * needed * exp(-filled)
    spare = min(int(empty + 4 * sqrt(empty)), needed) if parts == 3 else 0
    return Scheme(needed + spare, parts, differ, spare)


def _part_signatures(sets: list[np.ndarray], band: np.ndarray, schemes: list[Scheme]) -> list[np.ndarray]:
    """Signatures of sets whose schemes have the same parts."""
    parts, differ = schemes[0].parts, schemes[0].differ
    sizes = np.array([len(s) for s in sets])
    count = np.array([scheme.partitions for scheme in schemes])
    bases = np.cumsum(count) - count
    value = mixed(np.concatenate(sets) ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    owner = np.repeat(np.arange(len(sets)), sizes)
    first = (value >> np.uint64(20)).astype(np.int64) % count[owner]
    place = (bases[owner] + first) * parts + (value & np.uint64(0xFFFFF)).astype(np.int64) % parts
    order = np.argsort(place, kind="stable")
    total = np.zeros(parts * int(count.sum()), np.uint64)
    filled, begin = np.unique(place[order], return_index=True)
    total[filled] = np.add.reduceat(mixed(value)[order], begin)
    total = total.reshape(-1, parts)
    held = np.bincount(place, minlength=total.size).reshape(-1, parts)
    of = np.repeat(np.arange(len(sets)), count)
    name = mixed((band[of] * 1_000_003).astype(np.uint64) + np.arange(len(of)).astype(np.uint64) - bases[of].astype(np.uint64))
    signs, full = [], []
    for j, chosen in enumerate(combinations(range(parts), parts - differ)):
        joint = mixed(name + np.uint64(j))
        for i in chosen:
            joint = joint + total[:, i] * np.uint64(2 * i + 1)
        signs.append(mixed(joint))
        full.append(held[:, list(chosen)].any(axis=1))
    signs, full = np.stack(signs, axis=1).view(np.int64), np.stack(full, axis=1)
    # A set with more empty partitions than spare ones keeps its empty signatures.
    blank = np.add.reduceat((~full).any(axis=1).astype(np.int64), bases)
    keep = full | (blank > np.array([scheme.spare for scheme in schemes]))[of][:, None]
    stops = np.cumsum(np.add.reduceat(keep.sum(axis=1), bases))
    return np.split(signs[keep], stops[:-1])


def signatures(sets: list[np.ndarray], similarity: int) -> list[np.ndarray]:
    """Signatures of each set, for its own band and, where a larger partner may be there, the next."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out: list[list[np.ndarray]] = [[] for _ in sets]
    own, high, next_low = _band_of(sizes)
    for step in (0, 1):
        chosen = np.flatnonzero(sizes > 0 if step == 0 else (sizes > 0) & (100 * sizes >= similarity * next_low))
        if not len(chosen):
            continue
        band = own[chosen] + step
        limit = high[chosen] if step == 0 else _band_of(next_low[chosen])[1]
        apart = most_apart(limit, similarity)
        schemes = [scheme_of(x, y) for x, y in zip(limit.tolist(), apart.tolist())]
        for kind in {(scheme.parts, scheme.differ) for scheme in schemes if scheme}:
            at = [i for i, scheme in enumerate(schemes) if scheme and (scheme.parts, scheme.differ) == kind]
            found = _part_signatures([sets[chosen[i]] for i in at], band[at], [schemes[i] for i in at])
            for i, signs in zip(at, found):
                out[chosen[i]].append(signs)
        for i in np.flatnonzero(apart == 1).tolist():
            # The set and the set without one n-gram.
            value = mixed(sets[chosen[i]] ^ np.uint64(0xA5A5A5A5A5A5A5A5))
            whole = value.sum(dtype=np.uint64)
            name = mixed(np.array([band[i]], np.uint64) * np.uint64(1_000_003))
            out[chosen[i]].append(mixed(name + np.r_[whole, whole - value]).view(np.int64))
    return [np.concatenate(o) if o else np.zeros(0, np.int64) for o in out]


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Parity of the n-grams that fall on each bit: one row of words per set."""
    out = np.zeros((len(sets), SKETCH_BITS // 64), np.int64)
    for a in range(0, len(sets), 512):
        part = sets[a : a + 512]
        bits = (mixed(np.concatenate(part) ^ np.uint64(0x3C3C)) % np.uint64(SKETCH_BITS)).astype(np.int64)
        bits += np.repeat(np.arange(len(part)), [len(s) for s in part]) * SKETCH_BITS
        odd = np.bincount(bits, minlength=len(part) * SKETCH_BITS) & 1
        out[a : a + 512] = np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(len(part), -1)
    return out


def described(docs: DataFrame, n: int) -> DataFrame:
    """Per row: id, set size, fingerprint and sketch of the set."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text", 2 << 20):
            sets = shingle_sets(block.column("text"), n)
            sums = [(mixed(s).sum(dtype=np.uint64), mixed(s ^ np.uint64(0x5A5A)).sum(dtype=np.uint64)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    *(pa.array(np.array([s[j] for s in sums], np.uint64).view(np.int64)) for j in (0, 1)),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(sets) + 1, dtype=np.int32) * (SKETCH_BITS // 64)), pa.array(sketches(sets).ravel())
                    ),
                ],
                names=["doc_id", "n_shingles", "first", "second", "sketch"],
            )

    return docs.mapInArrow(describe, SETS)


def shared_signatures(docs: DataFrame, rows: DataFrame, leaders: DataFrame, n: int, similarity: int) -> DataFrame:
    """sign, doc_id, low, high: signatures that several classes have, with the smallest and largest of these.

    Documents none of whose rows leads a class are left out before anything is signed.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text", 2 << 20):
            found = signatures(shingle_sets(block.column("text"), n), similarity)
            ids = np.repeat(block.column("doc_id").to_numpy(), [len(f) for f in found])
            signs = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signs, pa.int64()), pa.array(ids, pa.int64())], names=["sign", "doc_id"])

    led = materialise(rows.select("doc_id").distinct().join(leaders.select("doc_id"), "doc_id", "left_anti"), "led")
    signed = without(docs, led, "doc_id").mapInArrow(sign, "sign long, doc_id long")
    ends = Window.partitionBy("sign")
    return signed.repartition("sign").withColumns({"low": F.min("doc_id").over(ends), "high": F.max("doc_id").over(ends)}).where("low < high").distinct()


def wide_sketch(grams: np.ndarray) -> bytes:
    """Parity of the n-grams that fall on each of four to eight bits per n-gram, a power of two of them."""
    width = max(64, 1 << int(4 * len(grams) - 1).bit_length())
    odd = np.bincount((mixed(grams ^ np.uint64(0x6969)) % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def least_apart(left: bytes, right: bytes) -> int:
    """Elements in which sets of these wide sketches differ at least; the wider one is folded to the width of the other."""
    x, y = (np.frombuffer(sketch, np.uint64) for sketch in (left, right))
    width = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(words.reshape(-1, width), axis=0) for words in (x, y))
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


def packed_sets(docs: DataFrame, n: int) -> DataFrame:
    """Per row of doc_id, text: the set as bytes, its size and its wide sketch."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text", 2 << 20):
            sets = shingle_sets(block.column("text"), n)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array([wide_sketch(s) for s in sets], pa.binary()),
                ],
                names=["doc_id", "grams", "held", "wide"],
            )

    return docs.mapInArrow(pack, "doc_id long, grams binary, held long, wide binary")


def possible_pairs(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Of the pairs (a, b), those whose sizes and wide sketches allow the similarity, which no similar pair's forbid."""

    def rule(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = (batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()).tolist()
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            good = [least_apart(p, q) * (100 + similarity) <= n * (100 - similarity) for p, q, n in zip(x, y, both)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left, right = (
        sets.select(F.col("doc_id").alias(k), F.col("held").alias(f"n_{k}"), F.col("wide").alias(w)) for k, w in (("a", "x"), ("b", "y"))
    )
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * similarity
    met = pairs.select("a", "b").join(left, "a").join(right, "b").where(fits)
    return met.select("a", "b", "n_a", "n_b", "x", "y").mapInArrow(rule, "a long, b long").distinct()


def verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Of the pairs (a, b), those whose sets are similar enough; sets go with those only that are possible."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            good = []
            for left, right in zip(x, y):
                both = np.concatenate([np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                good.append(100 * shared >= similarity * (len(both) - shared) and shared > 0)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("y"))
    possible = materialise(possible_pairs(pairs, sets, similarity), "possible")
    return possible.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")


def named_sets(docs: DataFrame, rows: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """Sets of the documents that occur in the pairs; ``rows`` has the ids of all documents, as often as they occur."""
    named = materialise(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "named")
    held = materialise(packed_sets(among(docs, named, "doc_id"), n), "grams")
    # Of repeated ids the smallest class is meant, whichever row that is: keep every set, each once.
    repeated = materialise(
        rows.select("doc_id").join(named, "doc_id", "left_semi").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated"
    )
    return without(held, repeated, "doc_id").unionByName(among(held, repeated, "doc_id").distinct())


def allowed_pairs(rows: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) with one sign, different labels and sketches near enough.

    Rows have sign, blocks, doc_id, label, n_shingles, sketch.  A sign's rows are
    cut into blocks, and every two blocks meet in a group of their own.
    """
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    met = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "sign", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "block", "doc_id", "label", "n_shingles", "sketch",
    )

    def pairs(table: pa.Table) -> pa.RecordBatch:
        ids, labels, sizes, blocks = (table.column(c).to_numpy() for c in ("doc_id", "label", "n_shingles", "block"))
        words = np.asarray(table.column("sketch").combine_chunks().flatten()).reshape(len(ids), -1).view(np.uint64)
        across = table.column("lo")[0].as_py() != table.column("hi")[0].as_py()
        found = [[], []]
        for i in range(0, len(ids), 128):
            own = slice(i, i + 128)
            differ = labels[own, None] != labels[None]
            differ &= ids[own, None] < ids[None]
            if across:
                differ &= blocks[own, None] != blocks[None]
            x, y = np.nonzero(differ)
            for k in range(0, len(x), 65_536):
                p, q = x[k : k + 65_536] + i, y[k : k + 65_536]
                apart = np.bitwise_count(words[p] ^ words[q]).sum(axis=1, dtype=np.int64)
                near = apart * (100 + similarity) <= (sizes[p] + sizes[q]) * (100 - similarity)
                found[0].append(ids[p[near]])
                found[1].append(ids[q[near]])
        empty = np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([empty, *f])) for f in found], names=["a", "b"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if kept is not None:
                table = pa.concat_tables([kept, table])
            keys = np.stack([table.column(c).to_numpy() for c in ("sign", "lo", "hi")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
            for a, b in zip(cuts, cuts[1:]):
                yield pairs(table.slice(a, b - a))
            kept = table.slice(cuts[-1]) if table.num_rows else None
        if kept is not None and kept.num_rows:
            yield pairs(kept)

    order = ["sign", "lo", "hi"]
    return met.repartition(*order).sortWithinPartitions(*order).mapInArrow(walk, "a long, b long")


def similar_groups(
    docs: DataFrame, n: int = 3, similarity: int = 90, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (its smallest reachable doc_id).

    ``similarity`` is in percent of the union.
    """
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    ).where("doc_id IS NOT NULL")
    rows = materialise(described(narrow, n), "sets")
    equal = ["n_shingles", "first", "second"]
    classes = materialise(
        rows.where("n_shingles > 0").groupBy(*equal).agg(F.min("doc_id").alias("class_id")), "classes"
    )
    members = rows.select("doc_id", *equal).join(classes, equal, "left").select(
        "doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id")
    )
    leaders = rows.join(classes.withColumnRenamed("class_id", "doc_id"), ["doc_id", *equal]).dropDuplicates(["doc_id", *equal])
    groups = materialise(shared_signatures(narrow, rows, classes.withColumnRenamed("class_id", "doc_id"), n, similarity), "groups")
    drawn = materialise(
        leaders.select("doc_id", "n_shingles", "sketch").join(groups.select("doc_id").distinct(), "doc_id"), "sketches"
    )

    ends = F.array(F.struct(F.col("low").alias("a"), F.col("doc_id").alias("b")), F.struct(F.col("doc_id").alias("a"), F.col("high").alias("b")))
    star = groups.select(F.inline(ends)).where("a < b").distinct()
    left, right = (
        drawn.select(F.col("doc_id").alias(k), F.col("n_shingles").alias(f"n_{k}"), F.col("sketch").alias(f"s_{k}"))
        for k in ("a", "b")
    )
    apart = F.aggregate(
        F.zip_with("s_a", "s_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y
    )
    possible = apart * (100 + similarity) <= (F.col("n_a") + F.col("n_b")) * (100 - similarity)
    star = materialise(star.join(left, "a").join(right, "b").where(possible).select("a", "b"), "pairs")
    links = materialise(verified(star, named_sets(narrow, rows, star, n), similarity), "links")

    # Pairs that share a signature and are not connected yet.
    labelled = groups.select("sign", "doc_id").join(
        components(links).withColumnRenamed("vertex", "doc_id"), "doc_id", "left"
    ).select("sign", "doc_id", F.coalesce("component_id", "doc_id").alias("label"))
    apart_groups = labelled.groupBy("sign").agg(
        F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("size")
    ).where("x < y").select("sign", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    rest = materialise(
        allowed_pairs(labelled.join(apart_groups, "sign").join(drawn, "doc_id"), similarity)
        .distinct().join(star, ["a", "b"], "left_anti"),
        "pairs",
    )
    more = verified(rest, named_sets(narrow, rows, rest, n), similarity)
    equals = members.where("doc_id <> class_id").select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
    everything = components(links.unionByName(more).unionByName(equals))
    return (
        members.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
        .join(everything.withColumnRenamed("vertex", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def similar_pairs(
    docs: DataFrame, n: int = 3, similarity: int = 90, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """All links: pairs (a < b) of classes that are similar, and the class of each document.

    A class is the documents with one set, named by the smallest id; the members
    (doc_id, n_shingles, class_id) of a class are all similar to each other and to
    those of the classes paired with it.  Unlike in ``similar_groups``, every pair
    that shares a signature and that the sketches allow is verified, so a group of
    many different near copies has as many rows as pairs.  Documents with an empty
    set have no class.  Give ids that are unique: an id with several sets can
    name several classes.
    """
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    ).where("doc_id IS NOT NULL")
    rows = materialise(described(narrow, n), "sets")
    equal = ["n_shingles", "first", "second"]
    classes = materialise(
        rows.where("n_shingles > 0").groupBy(*equal).agg(F.min("doc_id").alias("class_id")), "classes"
    )
    members = rows.select("doc_id", *equal).join(classes, equal, "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("class_id")).alias("class_id")
    ).distinct()
    leaders = materialise(
        rows.join(classes.withColumnRenamed("class_id", "doc_id"), ["doc_id", *equal]).dropDuplicates(["doc_id", *equal]), "leaders"
    )
    groups = materialise(shared_signatures(narrow, rows, leaders, n, similarity), "groups").select("sign", "doc_id")
    shared = groups.groupBy("sign").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    met = groups.join(shared, "sign").join(leaders.select("doc_id", "n_shingles", "sketch"), "doc_id")
    pairs = materialise(allowed_pairs(met.withColumn("label", F.col("doc_id")), similarity).distinct(), "pairs")
    return verified(pairs, named_sets(narrow, rows, pairs, n), similarity).distinct(), members
