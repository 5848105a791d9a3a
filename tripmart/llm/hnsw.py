"""Near-duplicate vectors through hierarchical navigable small-world graphs.

Vectors are dealt into shards by a hash of the id.  Each shard gets a graph of
nested layers (Malkov and Yashunin, 2016), stored in the shared folder, a row
per vector.  Every vector queries every shard: a greedy descent through the layers, then a beam
over the lowest one.  The beam of a query doubles while it holds nothing but
vectors near the threshold, and the beams of a block double until an audit
against an exact scan, for every ``audit_every``-th query of the block, finds the
wanted recall per query, for small and large groups separately; an exact scan takes the place of a doubled beam that would
cost more, and of one as wide as the shard.  What
the graph finds is verified by cosine in double precision.

A task reads the graph of one shard and then streams blocks of queries past it.  It
returns for each query the number of its links there, and a spanning forest of
the links it found, so groups of any size give rows in proportion to their
vectors, not to their pairs.  Links of queries with few of them are held for a block, those of
the others go into the forest as they are found.  Shards and blocks are sized by
rows and by bytes, and searches, insertions and scans run in pieces of at most ``PIECE_BYTES``, so
a task's memory depends on neither the table nor its groups.

Searches of a block run side by side in numpy, as do the insertions of a graph.

Defined cases: vectors that are null, zero or hold null or non-finite components
link with nothing and are their own component; only vectors of equal length
link; a repeated id counts once, with the row that comes first by its
vector; rows with null id are left out; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import among, materialise, row_blocks, split_count, without
from tripmart.llm.components import components
from tripmart.llm.vectors import comparable, matrix

ANSWERS = "vec_id long, other long, n_links long"
# Bytes of a shard's and of a block's vectors in double precision, and of what one piece of a search holds.
SHARD_BYTES, BLOCK_BYTES, PIECE_BYTES = 64 << 20, 8 << 20, 32 << 20
# Neighbours of a vector per layer (twice as many are held), links that one piece of a block may give, rows of a piece of a graph.
MOST, LINKS, GRAPH_ROWS = 12, 1 << 20, 4096
# Rows that an exact scan passes in the time that a beam takes for one of its places (about 800 measured, 88,140 rows of 64 numbers).
SCANNED = 512


class Layer:
    """Members (rows of the shard, in order of insertion) and their neighbours, -1 where there is none."""

    def __init__(self, members: np.ndarray, links: np.ndarray):
        self.members, self.links = members, links


def beam(points: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int, many: int = 3):
    """Best-first search of the queries, a piece of them side by side: rows found (-1: none) and similarities, best first."""
    width = min(width, len(points))
    each = len(points) + 40 * width + many * links.shape[1] * (32 + points.itemsize * points.shape[1])
    found, near = np.empty((len(queries), width), np.int64), np.empty((len(queries), width), np.float32)
    for a, b in row_blocks(len(queries), max(1, PIECE_BYTES // each)):
        found[a:b], near[a:b] = _beam(points, links, queries[a:b], entries[a:b], width, many)
    return found, near


def _beam(points: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int, many: int):
    n, count = len(points), len(queries)
    found = np.full((count, width), -1, np.int64)
    near = np.full((count, width), -np.inf, np.float32)
    open_ = np.zeros((count, width), bool)
    seen = np.zeros((count, n + 1), bool)
    seen[:, n] = True
    all_ = np.arange(count)
    found[:, 0], near[:, 0], open_[:, 0] = entries, np.einsum("qd,qd->q", points[entries], queries), True
    seen[all_, entries] = True
    active = all_
    while len(active):
        turn = np.argsort(~open_[active], axis=1, kind="stable")[:, :many]
        chosen = np.take_along_axis(found[active], turn, axis=1)
        good = np.take_along_axis(open_[active], turn, axis=1)
        np.put_along_axis(flags := open_[active], turn, False, axis=1)
        next_ = np.where(good[:, :, None], links[np.where(good, chosen, 0)], -1).reshape(len(active), -1)
        next_[next_ < 0] = n
        next_.sort(axis=1)
        next_[:, 1:][next_[:, 1:] == next_[:, :-1]] = n
        next_[seen[active[:, None], next_]] = n
        seen[active[:, None], next_] = True
        close = np.matmul(points[np.minimum(next_, n - 1)], queries[active][:, :, None])[:, :, 0]
        close[next_ == n] = -np.inf
        rows = np.concatenate([found[active], next_], axis=1)
        score = np.concatenate([near[active], close], axis=1)
        state = np.concatenate([flags, next_ < n], axis=1)
        best = np.argsort(-score, axis=1, kind="stable")[:, :width]
        near[active] = score = np.take_along_axis(score, best, axis=1)
        found[active] = np.where(np.isneginf(score), -1, np.take_along_axis(rows, best, axis=1))
        open_[active] = state = np.take_along_axis(state, best, axis=1) & ~np.isneginf(score)
        active = active[state.any(axis=1)]
    return found, near


def _step(candidates: int, points: np.ndarray) -> int:
    """Points whose candidates, and what these are to each other, fit into a piece."""
    return max(1, PIECE_BYTES // max(1, candidates * points.itemsize * (candidates + points.shape[1])))


def diverse(points: np.ndarray, rows: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` neighbours each: candidates that are nearer to the point than to any taken before, then the rest."""
    step = _step(rows.shape[1], points)
    if len(rows) > step:
        return np.concatenate([diverse(points, rows[a:b], near[a:b], most) for a, b in row_blocks(len(rows), step)])
    order = np.argsort(-near, axis=1, kind="stable")
    rows, near = np.take_along_axis(rows, order, axis=1), np.take_along_axis(near, order, axis=1)
    real = ~np.isneginf(near)
    held = points[np.where(real, rows, 0)]
    mutual = np.matmul(held, held.transpose(0, 2, 1))
    taken = np.zeros_like(real)
    for c in range(rows.shape[1]):
        hidden = (mutual[:, c] > near[:, c : c + 1]) & taken
        taken[:, c] = real[:, c] & ~hidden.any(axis=1)
    turn = np.argsort(np.where(taken, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :most]
    out = np.where(np.take_along_axis(real, turn, axis=1), np.take_along_axis(rows, turn, axis=1), -1)
    if out.shape[1] < most:
        out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
    return out


def linked(points: np.ndarray, entries: np.ndarray, most: int, width: int, batch: int = 512) -> np.ndarray:
    """Neighbours within one layer; ``entries`` are rows that come before those that start from them."""
    n = len(points)
    links = np.full((n, most), -1, np.int32)
    done = 0
    while done < n:
        stop = min(n, done + min(batch, max(64, done)))
        fresh = np.arange(done, stop)
        inner = points[fresh] @ points[fresh].T
        np.fill_diagonal(inner, -np.inf)
        keep = min(len(fresh), width)
        top = np.argpartition(-inner, keep - 1, axis=1)[:, :keep]
        rows, near = fresh[top], np.take_along_axis(inner, top, axis=1)
        if done:
            far, score = beam(points[:done], links[:done], points[fresh], np.minimum(entries[fresh], done - 1), width)
            rows, near = np.concatenate([rows, far], axis=1), np.concatenate([near, score], axis=1)
        links[fresh, : most // 2] = diverse(points, rows, near, most // 2)
        # The same links from the other end; full lists are chosen anew.
        source = np.repeat(fresh, most)
        target = links[fresh].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        owners, first, counts = np.unique(target, return_index=True, return_counts=True)
        turn = np.argsort(counts, kind="stable")
        a = 0
        while a < len(owners):
            b = min(len(owners), a + 512)
            b = min(b, a + _step(most + int(counts[turn[b - 1]]), points))
            own, more = owners[turn[a:b]], counts[turn[a:b]]
            place = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
            rows = np.full((b - a, most + more[-1]), -1, np.int32)
            rows[:, :most] = links[own]
            rows[np.repeat(np.arange(b - a), more), most + place] = source[np.repeat(first[turn[a:b]], more) + place]
            rows = np.sort(rows, axis=1)[:, ::-1].copy()
            rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = -1
            rows = np.sort(rows, axis=1)[:, ::-1][:, : max(1, int((rows >= 0).sum(axis=1).max()))]
            near = np.matmul(points[rows], points[own][:, :, None])[:, :, 0]
            near[rows < 0] = -np.inf
            links[own] = diverse(points, rows, near, most)
            a = b
        done = stop
    return links


def layer_sizes(n: int, most: int = MOST) -> list[int]:
    """Vectors of the layers, from the one that holds all to the top."""
    sizes = [n]
    while sizes[-1] > 64:
        sizes.append(max(1, sizes[-1] // most))
    return sizes


class Graph:
    """Layers from the top to the one that holds all vectors; points are unit vectors in order of insertion."""

    def __init__(self, points: np.ndarray, layers: list[Layer]):
        self.points, self.layers = points, layers

    @classmethod
    def build(cls, points: np.ndarray, most: int = MOST, width: int = 32) -> Graph:
        """Points must come in random order; the top of the order makes up the upper layers."""
        graph = cls(points, [])
        for size in reversed(layer_sizes(len(points), most)):
            entries = graph.entry(points[:size]) if graph.layers else np.zeros(size, np.int64)
            links = linked(points[:size], entries, 2 * most, width)
            graph.layers.append(Layer(np.arange(size), links))
        return graph

    def entry(self, queries: np.ndarray) -> np.ndarray:
        at = np.zeros(len(queries), np.int64)
        for layer in self.layers:
            size = len(layer.members)
            if size <= 64:
                at = (queries @ self.points[:size].T).argmax(axis=1)
            else:
                at = beam(self.points[:size], layer.links, queries, at, 4)[0][:, 0]
        return at

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        upper = Graph(self.points, self.layers[:-1])
        entries = upper.entry(queries) if upper.layers else np.zeros(len(queries), np.int64)
        return beam(self.points, self.layers[-1].links, queries, entries, width)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision, safe for very large and very small components."""
    out = np.empty(vectors.shape)
    for a, b in row_blocks(len(vectors), max(1, PIECE_BYTES // (32 * vectors.shape[1]))):
        scaled = vectors[a:b].astype(np.float64)
        scaled /= np.abs(scaled).max(axis=1, keepdims=True)
        out[a:b] = scaled / np.sqrt(np.square(scaled).sum(axis=1, keepdims=True))
    return out


def scanned(exact: np.ndarray, queries: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of all queries by an exact scan, in pieces: query rows and shard rows."""
    for a, b in row_blocks(len(queries), max(1, PIECE_BYTES // (16 * len(exact)))):
        q, r = np.nonzero(queries[a:b] @ exact.T >= threshold)
        yield a + q, r


def cosines(queries: np.ndarray, q: np.ndarray, exact: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Of pairs of unit vectors."""
    out = np.empty(len(q))
    for a, b in row_blocks(len(q), max(1, PIECE_BYTES // (16 * exact.shape[1]))):
        out[a:b] = np.einsum("qd,qd->q", queries[q[a:b]], exact[r[a:b]])
    return out


def wider(width: int, rows: int) -> int:
    """Twice the width of a beam, or all rows, which is an exact scan, where that costs less."""
    return rows if 2 * width * SCANNED >= rows else 2 * width


def within(graph: Graph, exact: np.ndarray, queries: np.ndarray, threshold: float, width: int, margin: float = 0.01):
    """Links of each query with cosine >= threshold: query rows and shard rows, verified.

    Beams that are full of near vectors get ``wider``, until they reach past the threshold.
    """
    out_q, out_r = [], []
    for a in range(0, len(queries), 256):
        part = np.arange(a, min(len(queries), a + 256))
        wide = width
        while len(part):
            if wide >= len(exact):
                for q, r in scanned(exact, queries[part], threshold):
                    out_q.append(part[q])
                    out_r.append(r)
                break
            step = max(1, (8 << 20) // max(1, wide * 64))
            full = []
            for b in range(0, len(part), step):
                own = part[b : b + step]
                rows, near = graph.search(queries[own].astype(np.float32), wide)
                more = near[:, -1] >= threshold - margin
                q, c = np.nonzero((near >= threshold - margin) & ~more[:, None])
                r = rows[q, c]
                sims = cosines(queries, own[q], exact, r)
                out_q.append(own[q][sims >= threshold])
                out_r.append(r[sims >= threshold])
                full.append(own[more])
            part, wide = np.concatenate(full), wider(wide, len(exact))
    if not out_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_q), np.concatenate(out_r)


class Trees:
    """Links between vertices 0, 1, ... as trees, whatever the number of links."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.parent = ids, np.arange(len(ids))

    def extend(self, ids: np.ndarray) -> np.ndarray:
        """New vertices for these ids."""
        fresh = np.arange(len(self.ids), len(self.ids) + len(ids))
        self.ids, self.parent = np.r_[self.ids, ids], np.r_[self.parent, fresh]
        return fresh

    def root(self, v: np.ndarray) -> np.ndarray:
        at = self.parent[v]
        while ((up := self.parent[at]) != at).any():
            at = up
        self.parent[v] = at
        return at

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root(a), self.root(b)
            apart = a != b
            a, b = np.maximum(a, b)[apart], np.minimum(a, b)[apart]
            np.minimum.at(self.parent, a, b)

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of linked vertices, each with the least id of its tree, but for these."""
        roots = self.root(np.arange(len(self.ids)))
        least = self.ids.copy()
        np.minimum.at(least, roots, self.ids)
        least = least[roots]
        apart = least != self.ids
        return self.ids[apart], least[apart]


class Joined:
    """Links of the queries of a block, by their number per query and joined in trees; ``vertices`` are those of the queries."""

    def __init__(self, trees: Trees, vertices: np.ndarray):
        self.trees, self.vertices, self.before = trees, vertices, trees.parent.copy()
        self.counted = np.zeros(len(vertices), np.int64)

    def add(self, q: np.ndarray, r: np.ndarray) -> None:
        a = self.vertices[q]
        self.counted += np.bincount(q[a != r], minlength=len(self.counted))
        self.trees.join(a, r)

    def clear(self) -> None:
        self.trees.parent = self.before.copy()
        self.counted[:] = 0


def audited(
    graph: Graph, exact: np.ndarray, queries: np.ndarray, threshold: float, width: int, recall: float, every: int, own: np.ndarray,
    joined: Joined | None = None,
):
    """``within``, with ``wider`` beams until the audited queries have the wanted recall.

    Recall is the mean over the audited queries that have links, for those with
    up to ``width`` links and those with more separately, so a large group cannot
    make up for small ones.  ``own`` is the shard row of each query (-1: in
    another shard), which is no link.  Links of queries with more than ``width`` are
    added to ``joined``, if it is given, and are not returned.
    """
    checked = np.arange(0, len(queries), every)
    true, bound = np.zeros(len(checked), np.int64), width
    for q, r in scanned(exact, queries[checked], threshold):
        true += np.bincount(q[r != own[checked[q]]], minlength=len(checked))
    few, many = (true > 0) & (true <= bound), true > bound
    counted = np.zeros(len(queries), np.int64)

    def search(asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out_q, out_r, a, step = [], [], 0, 16
        while a < len(asked):
            part = asked[a : a + step]
            q, r = within(graph, exact, queries[part], threshold, width)
            a, step = a + len(part), min(256, 2 * step, max(1, LINKS * len(part) // max(1, len(q))))
            q = part[q]
            counted[part] = np.bincount(q[r != own[q]], minlength=len(queries))[part]
            if joined:
                much = counted[q] > bound
                joined.add(q[much], r[much])
                q, r = q[~much], r[~much]
            out_q.append(q)
            out_r.append(r)
        return np.concatenate([np.zeros(0, np.int64), *out_q]), np.concatenate([np.zeros(0, np.int64), *out_r])

    q, r = search(np.arange(len(queries)))
    while width < len(exact):
        share = counted[checked] / np.maximum(true, 1)
        if many.any() and share[many].mean() < recall:
            again = np.arange(len(queries))
            if joined:
                joined.clear()
        elif few.any() and share[few].mean() < recall:
            again = np.flatnonzero(counted <= bound)
        else:
            break
        width = wider(width, len(exact))
        kept = ~np.isin(q, again)
        p, s = search(again)
        q, r = np.r_[q[kept], p], np.r_[r[kept], s]
    return q, r


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple[int, ...], pa.RecordBatch]]:
    """Slices of sorted batches with one key each, and their keys."""
    for batch in batches:
        if batch.num_rows:
            key = np.stack([batch.column(k).to_numpy() for k in keys], axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
                yield tuple(key[a].tolist()), batch.slice(a, b - a)


def lists(values: np.ndarray) -> pa.ListArray:
    """Rows of a matrix."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)), pa.array(values.ravel()))


def built(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Graphs of shards from their vectors: a row per vector in order of insertion, with its neighbours from the lowest layer up."""
    for (size, shard), group in groupby(runs(batches, ["size", "shard"]), key=lambda x: x[0]):
        table = pa.Table.from_batches([x[1].select(["vec_id", "vector"]) for x in group])
        ids, vectors = table.column("vec_id").to_numpy(), matrix(table.column("vector"), size)
        del table
        order = np.argsort(ids, kind="stable")
        order = order[np.random.default_rng(5).permutation(len(order))]
        ids, vectors = ids[order], vectors[order]
        layers = Graph.build(unit(vectors).astype(np.float32)).layers[::-1]
        ends = sorted({0, *layer_sizes(len(ids))})
        for start, end in zip(ends, ends[1:]):
            for a, b in row_blocks(end - start, GRAPH_ROWS):
                a, b = start + a, start + b
                places = np.arange(a, b, dtype=np.int32)
                links = np.concatenate([x.links[a:b] for x in layers if len(x.members) >= b], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(b - a, size, np.int32)), pa.array(np.full(b - a, shard, np.int32)), pa.array(places),
                        pa.array(np.full(b - a, len(ids), np.int32)), pa.array(ids[a:b]), lists(vectors[a:b]), lists(links),
                    ],
                    names=["size", "shard", "place", "of", "vec_id", "vector", "links"],
                )


def loaded(pieces: Iterable[pa.RecordBatch], size: int) -> tuple[Graph, np.ndarray, np.ndarray]:
    """A graph from its rows, its unit vectors in double precision and their ids."""
    at, layers = 0, []
    for piece in pieces:
        if not at:
            n = piece.column("of")[0].as_py()
            ids, exact = np.empty(n, np.int64), np.empty((n, size))
            layers = [np.empty((x, 2 * MOST), np.int32) for x in layer_sizes(n)]
        stop = at + piece.num_rows
        ids[at:stop] = piece.column("vec_id").to_numpy()
        exact[at:stop] = unit(matrix(piece.column("vector"), size))
        links = piece.column("links")
        flat, lengths = links.flatten().to_numpy(), pc.list_value_length(links).to_numpy()
        first = np.cumsum(lengths) - lengths
        for depth, layer in enumerate(layers):
            held = max(0, min(len(layer), stop) - at)
            layer[at : at + held] = flat[first[:held, None] + 2 * MOST * depth + np.arange(2 * MOST)]
        at = stop
    graph = Graph(exact.astype(np.float32), [Layer(np.arange(len(x)), x) for x in reversed(layers)])
    return graph, exact, ids


def answered(
    batches: Iterable[pa.RecordBatch], threshold: float, width: int, recall: float, audit_every: int
) -> Iterator[pa.RecordBatch]:
    """Numbers of links per query, and forests: of sorted rows, the graph of a shard (block -1), then its queries by block."""

    def answer(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], names=["vec_id", "other", "n_links"])

    keys = ["size", "shard", "part", "block"]
    for (size, _, _), group in groupby(runs(batches, keys), key=lambda x: x[0][:3]):
        trees = None
        for (*_, block), pieces in groupby(group, key=lambda x: x[0]):
            pieces = (x[1] for x in pieces)
            if block < 0:
                graph, exact, ids = loaded(pieces, size)
                trees, order = Trees(ids), np.argsort(ids)
            elif trees:
                asks = pa.Table.from_batches([x.select(["vec_id", "vector"]) for x in pieces])
                own, queries = asks.column("vec_id").to_numpy(), unit(matrix(asks.column("vector"), size))
                place = order[np.minimum(np.searchsorted(ids, own, sorter=order), len(ids) - 1)]
                place = np.where(ids[place] == own, place, -1)
                vertices = place.copy()
                vertices[place < 0] = trees.extend(own[place < 0])
                joined = Joined(trees, vertices)
                joined.add(*audited(graph, exact, queries, threshold, width, recall, audit_every, place, joined))
                some = joined.counted > 0
                yield answer(own[some], own[some], joined.counted[some])
        if trees:
            a, b = trees.forest()
            for start, stop in row_blocks(len(a), GRAPH_ROWS):
                yield answer(a[start:stop], b[start:stop], np.zeros(stop - start, np.int64))


def once(rows: DataFrame) -> DataFrame:
    """One stored row per vec_id and size: of repeated ids the row that comes first by its vector."""
    keys = rows.groupBy("vec_id", "size").agg(F.count("*").alias("n")).where("n > 1").select("vec_id").distinct()
    keys = materialise(keys, "repeated")
    if keys.isEmpty():
        return rows
    first = among(rows, keys, "vec_id").groupBy("vec_id", "size").agg(F.min("vector").alias("vector"))
    return materialise(without(rows, keys, "vec_id").unionByName(first), "vectors")


def near_duplicates(
    df: DataFrame, threshold: float = 0.95, shard_rows: int = 100_000, least_shards: int = 4,
    query_block: int = 8192, width: int = 24, recall: float = 0.99, audit_every: int = 64,
    id_col: str = "vec_id", vector_col: str = "embedding", task_rows: int = 65_536, least_tasks: int = 32,
) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept.

    A graph is read by a task per ``task_rows`` queries, or by more if there are fewer than ``least_tasks`` tasks.
    """
    rows = comparable(df, id_col, vector_col)
    if df.schema[vector_col].dataType.elementType.typeName() == "float":
        rows = rows.withColumn("vector", F.col("vector").cast("array<float>"))
    rows = once(materialise(rows, "vectors"))
    total, values = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    shards = max(split_count(total, shard_rows, least_shards), split_count(8 * values, SHARD_BYTES))
    blocks = max(split_count(total, query_block, 1), split_count(8 * values, BLOCK_BYTES))
    parts = max(split_count(total, task_rows, 1), min(blocks, split_count(least_tasks, shards)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    vector = rows.schema["vector"].dataType.simpleString()

    graphs = materialise(
        rows.withColumn("shard", shard).repartitionById(shards, F.col("shard")).sortWithinPartitions("size", "shard")
        .mapInArrow(built, f"size int, shard int, place int, of int, vec_id long, vector {vector}, links array<int>"),
        "graphs",
    )
    # Queries come in an order that has nothing to do with their ids.
    asks = (
        rows.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int"))
        .withColumn("part", F.pmod("block", F.lit(parts))).withColumn("shard", every(shards))
        .withColumn("at", F.xxhash64(F.lit(2), "vec_id"))
    )
    held = graphs.withColumn("block", F.lit(-1)).withColumn("part", every(parts)).withColumn("at", F.col("place").cast("long"))
    answers = materialise(
        held.drop("place").unionByName(asks, allowMissingColumns=True)
        .repartitionById(shards * parts, F.col("shard") * parts + F.col("part"))
        .sortWithinPartitions("size", "shard", "part", "block", "at")
        .mapInArrow(lambda batches: answered(batches, threshold, width, recall, audit_every), ANSWERS),
        "answers",
    )
    counts = answers.where("n_links > 0").groupBy("vec_id").agg(F.sum("n_links").alias("n_links"))
    joined = components(answers.where("n_links = 0"), "vec_id", "other")
    ids = df.select(F.col(id_col).cast("long").alias("vec_id")).where("vec_id IS NOT NULL").distinct()
    out = ids.join(counts, "vec_id", "left").join(joined.withColumnRenamed("vertex", "vec_id"), "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"), (component == F.col("vec_id")).alias("kept"),
    )
