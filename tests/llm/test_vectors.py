"""Near-duplicate vectors and nearest neighbours against brute force, and their defined cases."""

import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.llm import collisions, hnsw
from tripmart.llm.components import components

SCHEMA = "label string, vec_id long, embedding array<float>, vector string, shard int"


def table(spark, rows):
    return spark.createDataFrame([("x", i, v, "clash", 1) for i, v in rows], SCHEMA)


def groups_of(links, ids):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.fixture(scope="module")
def clustered():
    """A large group of near copies, exact copies, small groups, and loners."""
    rng = np.random.default_rng(1)
    big = rng.standard_normal(16)
    rows = [big + 0.03 * rng.standard_normal(16) for _ in range(150)]
    rows += [rows[0]] * 40
    for _ in range(60):
        seed = rng.standard_normal(16)
        rows += [seed, 3 * seed + 0.05 * rng.standard_normal(16)]
    rows += list(rng.standard_normal((100, 16)))
    return [(7 * i % 1009, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


def test_hnsw_equals_brute_force(spark, clustered):
    ids = np.array([i for i, _ in clustered])
    x = np.array([v for _, v in clustered])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = [(ids[a], ids[b]) for a, b in np.argwhere(np.triu(x @ x.T >= 0.95, 1))]
    degree = {int(i): 0 for i in ids}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    group = groups_of(links, ids.tolist())
    rows = hnsw.near_duplicates(table(spark, clustered), query_block=100, width=8).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows} == {
        i: (degree[i], group[i], group[i] == i) for i in degree
    }


def test_audit_sees_small_groups_beside_a_large_one(monkeypatch):
    """Narrow beams that lose every link of the small groups are widened, whatever the large group brings."""
    rng = np.random.default_rng(2)
    x = np.repeat(rng.standard_normal((101, 16)), [1000, *[2] * 100], axis=0)
    x = hnsw.unit(x + 0.001 * rng.standard_normal(x.shape))
    x = x[rng.permutation(len(x))]
    linked = x @ x.T >= 0.95
    small = linked.sum(axis=1) == 2
    assert small.sum() == 200

    def narrow(graph, exact, queries, threshold, width):
        q, r = np.nonzero(queries @ exact.T >= threshold)
        lost = (width < 64) & ((queries @ exact.T >= threshold).sum(axis=1)[q] == 2)
        return q[~lost], r[~lost]

    monkeypatch.setattr(hnsw, "within", narrow)
    rows = np.arange(len(x))
    q, r = hnsw.audited(None, x, x, 0.95, 16, 0.99, 8, rows)
    assert {(a, b) for a, b in zip(q.tolist(), r.tolist())} == {(a, b) for a, b in np.argwhere(linked).tolist()}


def peak_mb(work):
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_graph_is_built_in_bounded_memory():
    """Entries of all vectors of a shard were searched at once, which held neighbours and marks for each of them."""
    points = hnsw.unit(np.random.default_rng(4).standard_normal((6000, 128))).astype(np.float32)
    graph, peak = peak_mb(lambda: hnsw.Graph.build(points))
    assert peak < 100
    assert [len(x.links) for x in graph.layers] == [41, 500, 6000]


def test_links_of_a_large_group_are_not_held():
    """All pairs of a group of equal vectors would be 2,000 x 2,000; their numbers and one tree are kept."""
    ids = np.arange(2000)[::-1].copy()
    x = np.full((2000, 4), 0.5)
    graph, trees = hnsw.Graph.build(x.astype(np.float32)), hnsw.Trees(ids)
    joined = hnsw.Joined(trees, np.arange(2000))
    q, r = hnsw.audited(graph, x, x, 0.95, 24, 0.99, 64, np.arange(2000), joined)
    assert len(q) == len(r) == 0 and (joined.counted == 1999).all()
    a, b = trees.forest()
    assert sorted(a.tolist()) == list(range(1, 2000)) and not b.any()


def test_rows_of_a_graph_and_its_queries_in_any_batches(spark, clustered):
    """A shard's graph and several blocks reach a task in small batches; ids repeat and lengths differ."""
    rows = clustered + [(i, [9.0] * 16) for i, _ in clustered[:30]] + [(5000 + i, v[:8]) for i, v in clustered[:50]]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = hnsw.near_duplicates(table(spark, rows), query_block=40, width=8, task_rows=200).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    first = {}
    for i, v in rows:
        first[i] = min(first.get(i, v), v)
    links = []
    for size in (8, 16):
        own = [i for i, v in first.items() if len(v) == size]
        x = np.array([first[i] for i in own])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        links += [(own[a], own[b]) for a, b in np.argwhere(np.triu(x @ x.T >= 0.95, 1))]
    group = groups_of(links, list(first))
    degree = Counter(i for pair in links for i in pair)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {
        i: (degree[i], group[i], group[i] == i) for i in first
    }


ODD = [
    (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
    (7, [1.0, None]), (8, []), (9, [1.0, 0.0, 0.0]), (2, [2.0, 0.0]), (None, [1.0, 0.0]), (10, [1e30, 1e-30]),
]


def test_hnsw_defined_cases(spark):
    rows = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in hnsw.near_duplicates(table(spark, ODD)).collect()}
    alone = {i: (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)}
    assert rows == alone | {1: (2, 1, True), 2: (2, 1, False), 10: (2, 1, False)}


def test_no_vectors(spark):
    assert hnsw.near_duplicates(table(spark, [])).count() == 0
    assert collisions.nearest(table(spark, []), F.lit(True)).count() == 0


def test_neighbours_recall_and_scores(spark, clustered):
    ids, x = np.array([i for i, _ in clustered]), np.array([v for _, v in clustered])
    rows = collisions.nearest(table(spark, clustered), F.col("vec_id") % 5 == 0, k=10, query_block=16).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
    hits = total = 0
    for q in np.flatnonzero(ids % 5 == 0):
        far = np.sqrt(np.square(x - x[q]).sum(axis=1))
        order = [k for k in np.lexsort((ids, far)) if k != q][:10]
        got = found[ids[q]]
        assert got == sorted(got) and len(got) == 10 and ids[q] not in [i for _, i in got]
        assert all(s == pytest.approx(far[np.flatnonzero(ids == i)[0]], abs=1e-12) for s, i in got)
        hits += len({i for _, i in got} & set(ids[order].tolist()))
        total += 10
    assert hits >= 0.9 * total


def test_neighbours_defined_cases(spark):
    rows = collisions.nearest(table(spark, ODD), F.col("vec_id") <= 2, k=10).collect()
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in rows}
    # Fewer candidates than asked for: all of them; a repeated id counts once.
    assert {k: v[0] for k, v in got.items()} == {(1, 1): 2, (1, 2): 10, (2, 1): 1, (2, 2): 10}
    assert got[(1, 1)][1] == 1.0


def test_copies_at_one_distance_come_by_id(spark):
    rows = table(spark, [(i, [1.0, 2.0]) for i in range(300, 0, -1)])
    got = collisions.nearest(rows, F.col("vec_id") == 7, k=10).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 2, 3, 4, 5, 6, 8, 9, 10, 11]


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(3)
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    rest = [tuple(int(v) for v in rng.integers(2000, 2200, 2)) for _ in range(90)]
    links = chain + star + rest + [(5, 5), (None, 3), (4, None)]
    got = {r.vertex: r.component_id for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    true = [(a, b) for a, b in links if a is not None and b is not None]
    group = groups_of(true, sorted({v for p in true for v in p}))
    assert got == {v: c for v, c in group.items() if v != c}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
