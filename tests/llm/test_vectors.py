"""Near-duplicate vectors and nearest neighbours against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfstream.llm import vector_search
from shelfstream.llm.vector_dedup import Tree, duplicate_vectors, op6_embedding_dedup, spill_width
from shelfstream.llm.vector_search import KMeansTree, nearest_neighbours, op9_vector_search

SCHEMA = "vec_id long, embedding array<float>, n_links string, score int"


def _near(seed, n=400, dim=24, noise=0.05):
    """Vectors in groups of copies, some equal, some near the bound, and loners."""
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        base = rng.normal(size=dim)
        for _ in range(int(rng.choice([1, 1, 1, 2, 5, 30]))):
            copy = base if rng.random() < 0.2 else base + rng.normal(size=dim) * noise * rng.integers(1, 5)
            rows.append((copy * rng.uniform(0.5, 2)).astype(np.float32))
    order = rng.permutation(10 * n)[:n]
    return [(int(i), v.tolist()) for i, v in zip(order, rows, strict=False)]


def _slow_dedup(rows, min_cosine=0.95):
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], dtype=float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = u @ u.T >= min_cosine
    np.fill_diagonal(linked, False)
    comp = np.array(ids)
    while True:
        low = np.array([min([comp[k], *comp[linked[k]]]) for k in range(len(ids))])
        if (low == comp).all():
            return sorted((i, int(linked[k].sum()), int(comp[k]), i == comp[k]) for k, i in enumerate(ids))
        comp = low


def _table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("options", [{}, {"leaf_rows": 30}, {"leaf_rows": 60, "block_rows": 12}])
def test_links_equal_brute_force(spark, options):
    rows = _near(len(options))
    got = duplicate_vectors(_table(spark, rows), **options)
    assert sorted(map(tuple, got.collect())) == _slow_dedup(rows)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(map(tuple, op6_embedding_dedup(spark, sf_dir).collect())) == _slow_dedup(rows)


def test_pairs_at_the_bound_stay_together():
    rng = np.random.default_rng(4)
    dim, n = 64, 4000
    points = rng.normal(size=(n, dim))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    other = rng.normal(size=(n, dim))
    other -= (other * points).sum(1, keepdims=True) * points
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    pairs = 0.95 * points + math.sqrt(1 - 0.95**2) * other
    missed = np.ones(n, dtype=bool)
    for _ in range(5):
        tree = Tree(points, 5, spill_width(0.95, dim), rng)
        sets = [[set() for _ in range(n)] for _ in range(2)]
        for side, x in zip(sets, (points, pairs), strict=True):
            for row, leaf in zip(*tree.leaves(x), strict=True):
                side[row].add(leaf)
        missed &= np.array([not (a & b) for a, b in zip(*sets, strict=True)])
    assert missed.mean() < 0.001


ODD = [
    (50, None), (51, []), (52, [0.0] * 4), (53, [1.0, None, 0.0, 0.0]), (54, [1.0, math.nan, 0.0, 0.0]),
    (55, [math.inf, 0.0, 0.0, 0.0]), (56, [1.0, 0.0]), (None, [1.0, 0.0, 0.0, 0.0]),
]
GOOD = [(1, [1.0, 0.0, 0.0, 0.0]), (2, [1.0, 0.0, -0.0, 0.0]), (2, [1.0, 0.0, 0.0, 0.0]),
        (7, [0.0, 1.0, 0.0, 0.0]), (5, [0.0, 3e38, 0.1, 0.0]), (9, [1.0, 1.0, 1.0, 1e-38])]


def test_odd_vectors_link_with_nothing(spark):
    got = duplicate_vectors(_table(spark, [*ODD, *GOOD])).collect()
    rows = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in got)
    odd = [(str(i), 0, i, True) for i, _ in ODD]
    good = [("1", 2, 1, True), ("2", 2, 1, False), ("2", 2, 1, False), ("7", 1, 5, False), ("5", 1, 5, True),
            ("9", 0, 9, True)]
    assert rows == sorted([*odd, *good])
    assert duplicate_vectors(_table(spark, []).limit(0)).collect() == []
    assert {r.n_links for r in duplicate_vectors(_table(spark, ODD[:3])).collect()} == {0}


def _slow_search(rows, is_query, k=20):
    out = []
    usable = {(i, tuple(v)) for i, v in rows}
    for q, query in usable:
        if not is_query(q):
            continue
        found = {(i, sum(np.float64(a) * np.float64(b) for a, b in zip(v, query, strict=True)))
                 for i, v in usable if i != q}
        best = sorted(found, key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, rank + 1, i, round(s, 6)) for rank, (i, s) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 9, "block_queries": 3, "leaf_rows": 40}])
def test_search_with_every_leaf_equals_brute_force(spark, blocks):
    rng = np.random.default_rng(6)
    rows = [(i, rng.integers(-3, 4, 5).tolist()) for i in range(250)]
    rows = [(i, v) for i, v in rows if any(v)]
    table = _table(spark, [(i, [float(x) for x in v]) for i, v in rows] + ODD)
    got = nearest_neighbours(table, F.col("vec_id") % 7 == 0, recall=1.1, **blocks).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == _slow_search(rows, lambda i: i % 7 == 0)


def test_ties_repeats_and_few_candidates(spark):
    copies = [(6, [0.5, 0.5])] * 30 + [(i, [0.1, 0.1]) for i in range(50, 70)] + [(40, [1.0, 1.0])]
    got = nearest_neighbours(_table(spark, copies), F.col("vec_id") % 20 == 0).collect()
    first = sorted((r["rank"], r.vec_id) for r in got if r.query_id == 40)
    assert first == list(enumerate([6, *range(50, 69)], 1))
    rows = [(20, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0]), (2, [1.0, -1.0]), (8, [-1.0, 0.0])]
    got = nearest_neighbours(_table(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, got)) == [(20, 1, 2, 1.0), (20, 2, 3, 1.0), (20, 3, 8, -1.0)]
    empty = _table(spark, rows).limit(0)
    assert nearest_neighbours(empty, F.col("vec_id") % 20 == 0).collect() == []
    assert nearest_neighbours(_table(spark, rows[:2]), F.col("vec_id") % 20 == 0).collect() == []


def test_many_equal_vectors(spark):
    rows = [(i, [0.3, 0.1, 0.7]) for i in range(1, 400)] + [(400, [0.3, 0.1, 0.6])]
    got = nearest_neighbours(
        _table(spark, rows), F.col("vec_id") % 20 == 0, block_rows=50, block_queries=4
    ).collect()
    for q in range(20, 401, 20):
        own = [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
        assert own == [i for i in range(1, 22) if i != q][:20]


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_calibration_widens_until_recall(spark, conf, coalesce):
    conf(adaptive__coalescePartitions__enabled=coalesce, shuffle__partitions="16")
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1500, 12)).astype(np.float32))]
    table = _table(spark, rows)
    got = nearest_neighbours(table, F.col("vec_id") % 20 == 0, recall=0.95, leaf_rows=20).collect()
    want = _slow_search(rows, lambda i: i % 20 == 0)
    hit = {(r.query_id, r.vec_id) for r in got} & {(q, i) for q, _, i, _ in want}
    assert len(got) == len(want) and 0.9 <= len(hit) / len(want)


def test_query_recall_and_scores(spark):
    tables = "/root/testdata/sf0.01"
    rows = {r.vec_id: np.array(r.embedding, dtype=float)
            for r in spark.read.parquet(f"{tables}/embeddings.parquet").collect()}
    got = op9_vector_search(spark, tables).collect()
    ids = np.array(sorted(rows))
    x = np.array([rows[i] for i in ids])
    hit = 0
    for q in ids[ids % 20 == 0]:
        own = {r.vec_id: r.score for r in got if r.query_id == q}
        scores = x @ rows[q]
        scores[ids == q] = -np.inf
        hit += len(set(own) & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
        assert all(s == pytest.approx(rows[q] @ rows[i], abs=1e-12) for i, s in own.items())
    assert len(got) == 20 * (ids % 20 == 0).sum() and hit / len(got) >= 0.9


def test_visits_come_out_best_bin_first_and_all():
    points = np.random.default_rng(1).normal(size=(600, 6))
    tree = KMeansTree(points, 40)
    order = list(tree.visits(points[0]))
    assert sorted(order) == list(range(tree.n_leaves)) and tree.n_leaves > 8
    assert set(tree.leaf(points)) <= set(order)
    bins = vector_search._Bins({0: 5, 1: 4, 2: 30, 3: 2, 7: 9}, 10)
    assert bins.of == {0: 0, 1: 0, 2: 1, 3: 2, 7: 3} and bins.blocks == {0: 1, 1: 3, 2: 1, 3: 1}
