"""Nearest neighbours by inner product in a hierarchical k-means tree.

The tree is fitted on a bounded sample, and every vector is put into a leaf. A query walks the
tree best bin first: a priority queue holds the nodes seen so far, the most promising is opened
next, and leaves come out in the order they are worth visiting. How many are visited is
calibrated: it is widened until a sample of queries finds the wanted share of its true
neighbours, which are found by comparing that sample with all rows.

Vectors of different length have no inner product: each length has a tree of its own, but for
lengths with less than a leaf of vectors (and those beyond the commonest ``MAX_WIDTHS``), whose
queries are compared with all vectors of their length.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfstream.llm.common import keep, read_table, share_by_hash
from shelfstream.llm.vectors import (
    common_widths,
    matrix,
    packed_vectors,
    sample_vectors,
    vector_kind,
)

NEIGHBOURS = 20
#: Wanted share of true neighbours among the calibration queries.
RECALL = 0.97
#: About this many queries calibrate, twice that at the very most.
CALIBRATE = 200
#: The tree is fitted on about this many vectors, twice that at the very most.
SAMPLE = 16_384
BRANCHES = 8
#: Vectors per leaf, about, and the largest number of leaves.
LEAF_ROWS = 256
MAX_LEAVES = 2_048
#: A task compares about this many rows with this many queries at most.
BLOCK_ROWS = 8_192
BLOCK_QUERIES = 4_096
#: Places that lengths without a tree share.
SHARED_LEAVES = 64
SEED = 3


def _k_means(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(8):
        own = _nearest(points, centres)
        for c in np.unique(own):
            centres[c] = points[own == c].mean(axis=0)
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


class KMeansTree:
    """Centres and radii per node; leaves are numbered."""

    def __init__(self, points: np.ndarray, leaves: int):
        rng = np.random.default_rng(SEED)
        self.children: list[list[int]] = [[]]
        self.centres = [points.mean(axis=0) if len(points) else np.zeros(points.shape[1])]
        self.radii = [0.0]
        self.leaf_of: dict[int, int] = {}
        leaf_points = max(2 * BRANCHES, len(points) // max(1, leaves))
        todo = [(0, points)]
        while todo:
            node, own = todo.pop()
            if len(own) <= leaf_points:
                self.leaf_of[node] = len(self.leaf_of)
                continue
            centres = _k_means(own, BRANCHES, rng)
            place = _nearest(own, centres)
            if len(np.unique(place)) < 2:
                self.leaf_of[node] = len(self.leaf_of)
                continue
            for c in np.unique(place):
                part = own[place == c]
                self.children[node].append(len(self.centres))
                self.children.append([])
                self.centres.append(centres[c])
                # The usual distance of its points: how far beyond the centre a bin reaches.
                self.radii.append(float(np.sqrt(((part - centres[c]) ** 2).sum(axis=1).mean())))
                todo.append((len(self.centres) - 1, part))
        self.centres = np.array(self.centres)
        self.radii = np.array(self.radii)

    @property
    def n_leaves(self) -> int:
        return len(self.leaf_of)

    def leaf(self, points: np.ndarray) -> np.ndarray:
        """The leaf each point falls into."""
        out = np.zeros(len(points), dtype=np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf_of[node]
                continue
            place = _nearest(points[rows], self.centres[kids])
            todo += [(kid, rows[place == c]) for c, kid in enumerate(kids) if (place == c).any()]
        return out

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        promise = -(self.centres @ query + np.sqrt(query @ query) * self.radii)
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                yield self.leaf_of[node]
            for kid in self.children[node]:
                heapq.heappush(queue, (promise[kid], kid))


# ---------------------------------------------------------------- comparing


def _candidates(
    queries: np.ndarray, q_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, row, score) of all rows that may be among a query's ``k`` best, without its own.

    A matrix product finds who can be among them, all ties included; those are summed one by
    one, so that equal vectors have equal scores whatever their place.
    """
    step = max(1, (1 << 20) // max(1, len(points)))
    for at in range(0, len(queries) if len(points) else 0, step):
        rough = queries[at : at + step] @ points.T
        slack = 1e-9 * (1 + np.abs(rough).max())
        rough[q_ids[at : at + step, None] == ids[None, :]] = -np.inf
        if len(points) > k:
            place = len(points) - k
            bound = np.partition(rough, place, axis=1)[:, place, None] - slack
        else:
            bound = np.full((len(rough), 1), -np.inf)
        q, p = np.nonzero((rough >= bound) & (rough > -np.inf))
        for part in range(0, len(q), 1 << 16):
            own, row = q[part : part + (1 << 16)] + at, p[part : part + (1 << 16)]
            yield own, row, (points[row] * queries[own]).sum(axis=1)


def _best(
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (query, row, score) the ``k`` of largest score per query, ties to the smaller id."""
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    q, row, score = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((ids[row], -score, q))
    q, row, score = q[order], row[order], score[order]
    first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
    place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return q[place < k], row[place < k], score[place < k]


_FOUND = "query_id long, vec_id long, score double"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def exact_neighbours(packed: DataFrame, queries: list[tuple[int, bytes]], k: int, kind: str) -> DataFrame:
    """The true neighbours of a few queries among all rows: query_id, vec_id, score, v."""
    ids = np.array([q for q, _ in queries], dtype=np.int64)
    asked = matrix([v for _, v in queries], kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A repeated row counts once.
            rows = batch.to_pandas().drop_duplicates(["vec_id", "v"])
            own = rows["vec_id"].to_numpy()
            q, row, score = _best(
                list(_candidates(asked, ids, matrix(rows["v"], kind), own, k)), own, k
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[q]), pa.array(own[row]), pa.array(score),
                 pa.array(rows["v"].to_numpy()[row], pa.binary())],
                ["query_id", "vec_id", "score", "v"],
            )

    found = packed.select("vec_id", "v").mapInArrow(run, _FOUND + ", v binary")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.dropDuplicates(["query_id", "vec_id", "score"])
    return once.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= k).drop("_at")


def calibrated_visits(
    tree: KMeansTree, packed: DataFrame, queries: DataFrame, k: int, kind: str,
    recall: float = RECALL, most: int = CALIBRATE,
) -> int:
    """The number of leaves to visit, widened until the sample finds ``recall`` of its neighbours."""
    chosen = queries.filter(share_by_hash(["vec_id"], most, queries.count())).limit(2 * most)
    sample = sorted((r.vec_id, bytes(r.v)) for r in chosen.select("vec_id", "v").collect())
    if not sample:
        return 1
    truth = exact_neighbours(packed, sample, k, kind).select("query_id", "v").collect()
    leaf = tree.leaf(matrix([bytes(r.v) for r in truth], kind)) if truth else []
    order = {q: {x: i for i, x in enumerate(tree.visits(matrix([v], kind)[0]))} for q, v in sample}
    needed = np.array([order[r.query_id][x] + 1 for r, x in zip(truth, leaf, strict=True)])
    visits = 1
    while len(needed) and visits < tree.n_leaves and (needed <= visits).mean() < recall:
        visits += 1
    return visits


class Index:
    """A tree and its number of visits for each length that has one; leaves numbered through.

    Other lengths fall into the last ``SHARED_LEAVES`` leaves, each length into one.
    """

    def __init__(self, trees: dict[int, tuple[KMeansTree, int]]):
        self.trees, self.first, self.shared = trees, {}, 0
        for width, (tree, _) in trees.items():
            self.first[width] = self.shared
            self.shared += tree.n_leaves

    def leaf(self, raws: list[bytes], kind: str) -> np.ndarray:
        """The leaf of each packed vector."""
        widths = _widths(raws, kind)
        out = self.shared + widths % SHARED_LEAVES
        for width in np.unique(widths).tolist():
            if width in self.trees:
                own = np.flatnonzero(widths == width)
                out[own] = self.first[width] + self.trees[width][0].leaf(matrix([raws[i] for i in own], kind))
        return out

    def visits(self, raw: bytes, kind: str, sizes: dict[int, int], enough: int) -> Iterator[int]:
        """Leaves to compare a query with; more than calibrated until ``enough`` rows are met."""
        width = int(_widths([raw], kind)[0])
        if width not in self.trees:
            yield self.shared + width % SHARED_LEAVES
            return
        tree, visits = self.trees[width]
        met = 0
        for at, leaf in enumerate(tree.visits(matrix([raw], kind)[0])):
            if at >= visits and met >= enough:
                return
            yield self.first[width] + leaf
            met += sizes.get(self.first[width] + leaf, 0)


def _widths(raws, kind: str) -> np.ndarray:
    return np.array([len(v) for v in raws], dtype=np.int64) // np.dtype(kind).itemsize


def fit_index(packed: DataFrame, is_query, k: int, kind: str, recall: float, leaf_rows: int) -> Index:
    """Trees of the commonest lengths with more vectors than a leaf; the sample is shared."""
    widths, trees = common_widths(packed, leaf_rows), {}
    for width, n in widths.items():
        own = packed.filter(F.col("width") == width)
        points = sample_vectors(own, SAMPLE // len(widths), kind)
        tree = KMeansTree(points, min(MAX_LEAVES, max(1, n // leaf_rows)))
        trees[width] = tree, calibrated_visits(tree, own, own.filter(is_query), k, kind, recall)
    return Index(trees)


def nearest_neighbours(
    table: DataFrame, is_query, k: int = NEIGHBOURS, recall: float = RECALL,
    leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score: per query its ``k`` nearest by inner product.

    ``table`` has ``vec_id`` and ``embedding``; ``is_query`` is a condition on ``vec_id``. All
    rows but those with the query's id are candidates. Vectors that take no part (see
    :func:`~shelfstream.llm.vectors.packed_vectors`) neither ask nor answer. A repeated row
    counts once; only vectors of the query's length answer. Ties go to the smaller id; with
    fewer candidates all are returned. A query also widens its visits until it has met twice
    as many rows as it wants. Other columns are ignored; no rows give no rows.
    """
    kind = vector_kind(table)
    packed = keep(packed_vectors(table).filter("key is not null"), "vectors")
    index = fit_index(packed, is_query, k, kind, recall, leaf_rows)
    queries = packed.filter(is_query)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = index.leaf(batch.column("v").to_pylist(), kind)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "v")), pa.array(leaf)], ["vec_id", "v", "leaf"]
            )

    indexed = keep(
        packed.select("vec_id", "v").mapInArrow(place, "vec_id long, v binary, leaf long"), "index"
    )
    # One row per leaf at most: bounded by the size of the trees.
    sizes = {r.leaf: r.n for r in indexed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}

    bins = _Bins(sizes, block_rows)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, lists = [], [], []
            for i, query in enumerate(batch.column("v").to_pylist()):
                by_bin = {}
                for leaf in index.visits(query, kind, sizes, 2 * k):
                    if leaf in sizes:
                        by_bin.setdefault(bins.of[leaf], []).append(leaf)
                rows += [i] * len(by_bin)
                places += by_bin.keys()
                lists += by_bin.values()
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [taken.column("vec_id"), taken.column("v"), pa.array(places, pa.int64()),
                 pa.array(lists, pa.list_(pa.int64()))],
                ["query_id", "v", "bin", "leaves"],
            )

    schema = "query_id long, v binary, bin long, leaves array<long>"
    visited = keep(queries.select("vec_id", "v").mapInArrow(visit, schema), "visits")
    asked = {r.bin: r.n for r in visited.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect()}
    q_blocks = {x: -(-n // block_queries) for x, n in asked.items()}

    def deal_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.array([bins.of[x] for x in batch.column("leaf").to_pylist()], dtype=np.int64)
            yield _dealt(batch, place, batch.column("vec_id"), bins.blocks, q_blocks, "s", "t")

    def deal_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("bin").to_numpy()
            rest = batch.drop_columns(["bin"])
            yield _dealt(rest, place, batch.column("query_id"), q_blocks, bins.blocks, "t", "s")

    left = indexed.mapInArrow(deal_rows, "vec_id long, v binary, leaf long, bin long, s long, t long")
    right = visited.mapInArrow(
        deal_queries, "query_id long, v binary, leaves array<long>, bin long, t long, s long"
    )

    def search(rows, quests):
        import pandas as pd

        rows = rows.drop_duplicates(["vec_id", "v"])  # a repeated row counts once
        found, ids = [], rows["vec_id"].to_numpy()
        q_ids = quests["query_id"].to_numpy()
        if len(rows) and len(quests):
            lists = quests["leaves"].to_list()
            who, wanted = np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.concatenate(lists)
            of_row, of_query = _widths(rows["v"], kind), _widths(quests["v"], kind)
            leaf = rows["leaf"].to_numpy()
            for width in np.unique(of_query):
                held, asking = np.flatnonzero(of_row == width), np.flatnonzero(of_query == width)
                points, asked = matrix(rows["v"].iloc[held], kind), matrix(quests["v"].iloc[asking], kind)
                for one in np.unique(leaf[held]):
                    own = np.flatnonzero(leaf[held] == one)
                    q = np.flatnonzero(np.isin(asking, who[wanted == one]))
                    found += [
                        (asking[q[i]], held[own[row]], score)
                        for i, row, score in _candidates(
                            asked[q], q_ids[asking[q]], points[own], ids[held[own]], k
                        )
                    ]
        q, row, score = _best(found, ids, k)
        return pd.DataFrame({"query_id": q_ids[q], "vec_id": ids[row], "score": score})

    by = ["bin", "s", "t"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(search, _FOUND)
    return _ranked(found.distinct(), k)


class _Bins:
    """Neighbouring leaves put together until they hold about a task's rows.

    A leaf with more is a bin of its own and is cut into blocks. There are no more bins than
    leaves, whose number is bounded.
    """

    def __init__(self, sizes: dict[int, int], most: int):
        self.of: dict[int, int] = {}
        self.blocks: dict[int, int] = {}
        number, held = 0, 0
        for leaf, n in sorted(sizes.items()):
            if held and held + n > most:
                number, held = number + 1, 0
            self.of[leaf] = number
            held += n
            self.blocks[number] = -(-held // most)


def _dealt(
    batch: pa.RecordBatch, place: np.ndarray, ids: pa.Array, own: dict[int, int],
    others: dict[int, int], own_name: str, other_name: str,
) -> pa.RecordBatch:
    """Rows with their bin and block, once for each block of the other side of the bin."""
    mixed = ids.to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
    block = mixed.astype(np.int64) % np.array([own.get(x, 1) for x in place.tolist()] or [1])[: len(place)]
    times = np.array([others.get(x, 0) for x in place.tolist()], dtype=np.int64)
    row = np.repeat(np.arange(len(place)), times)
    other = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    taken = batch.take(pa.array(row))
    return pa.RecordBatch.from_arrays(
        [*taken.columns, pa.array(place[row]), pa.array(block[row]), pa.array(other)],
        [*batch.schema.names, "bin", own_name, other_name],
    )


def op9_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vectors of each vector whose id is divisible by 20."""
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
