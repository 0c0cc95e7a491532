"""Near-duplicate vectors by a forest of random-projection trees with spill.

A tree splits space by random directions at the median. A vector near a split goes to both
sides, so close pairs are rarely parted, and each further tree is another chance. Trees are
built on a bounded sample; all vectors are sent down them, and those that meet in a leaf are
compared and connected. What the links connect is then compared in full, which gives each
vector its number of links.

A tree has the same size for any number of vectors: its first levels hold a direction and a
median per node, deeper ones share a direction by level and a median by the node of the first
levels above. Vectors of different length never meet: each length has a forest of its own, but
for lengths with less than a leaf of vectors (and those beyond the commonest ``MAX_WIDTHS``),
which are one leaf each.

Equal vectors are one row from the start. A leaf or component too large for one task is cut
into blocks, and each pair of blocks is a group of its own; no pairs are listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream.llm.common import keep, read_table
from shelfstream.llm.components import components
from shelfstream.llm.vectors import (
    common_widths,
    matrix,
    packed_vectors,
    sample_vectors,
    unit,
    vector_kind,
)

MIN_COSINE = 0.95
TREES = 8
#: The trees are built on about this many vectors, twice that at the very most.
SAMPLE = 8_192
#: Vectors of a leaf, about, before spill; the trees grow deeper with the table.
LEAF_ROWS = 1_024
#: Levels whose nodes have a direction and a split each.
TOP_LEVELS = 8
#: Levels with twice the spill.
WIDE_LEVELS = 3
#: More levels than any table asks for.
MAX_DEPTH = 48
#: Leaves and components with more rows than this are compared in blocks.
BLOCK_ROWS = 4_096
SEED = 5


class Tree:
    """Random splits of the unit sphere, kept as arrays; node i has the children 2i+1, 2i+2.

    Its size is bounded by ``TOP_LEVELS`` and ``MAX_DEPTH``, whatever the number of vectors.
    """

    def __init__(self, points: np.ndarray, depth: int, spill: float, rng: np.random.Generator):
        self.depth, self.spill, self.top = depth, spill, min(depth, TOP_LEVELS)
        nodes, deeper = (1 << self.top) - 1, depth - self.top
        self.directions = unit(rng.standard_normal((nodes, points.shape[1])))
        self.splits = np.zeros(nodes)
        held = {0: points}
        for node in range(nodes):
            own = held.pop(node)
            along = own @ self.directions[node]
            self.splits[node] = np.median(along) if len(own) else 0.0
            left = along <= self.splits[node]
            held[2 * node + 1], held[2 * node + 2] = own[left], own[~left]
        self.deeper = unit(rng.standard_normal((deeper, points.shape[1])))
        self.deeper_splits = np.array([
            np.median(held[nodes + i] @ self.deeper.T, axis=0) if len(held[nodes + i]) else np.zeros(deeper)
            for i in range(nodes + 1)
        ])

    @property
    def size(self) -> int:
        """Numbers it holds."""
        return sum(x.size for x in (self.directions, self.splits, self.deeper, self.deeper_splits))

    def leaves(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for each leaf a point falls into or lies within the spill of."""
        row, node = np.arange(len(points)), np.zeros(len(points), dtype=np.int64)
        for level in range(self.depth):
            below = level - self.top
            if below < 0:
                along = np.einsum("ij,ij->i", points[row], self.directions[node]) - self.splits[node]
            else:
                above = (node + 1 >> below) - (1 << self.top)
                along = (points @ self.deeper[below])[row] - self.deeper_splits[above, below]
            spill = 2 * self.spill if level < WIDE_LEVELS else self.spill
            left, right = along <= spill, along > -spill
            row, node = (
                np.concatenate([row[left], row[right]]),
                np.concatenate([2 * node[left] + 1, 2 * node[right] + 2]),
            )
        return row, node


def spill_width(min_cosine: float, dimensions: int) -> float:
    """How far beyond a split both sides take a vector, below the first levels.

    Two unit vectors with ``min_cosine`` lie some distance apart, of which a random direction
    shows ``1 / sqrt(dimensions)`` in the root mean square; a quarter of that is the spill.
    For random vectors a split then parts one in 20 of the pairs at the bound and repeats one
    in 16 vectors, so that the copies grow as the 0.09th power of the table. A pair must be
    parted in all trees to be lost.
    """
    return 0.25 * np.sqrt(max(0.0, 2 - 2 * min_cosine)) / np.sqrt(max(1, dimensions))


def build_forest(points: np.ndarray, n: int, min_cosine: float, trees: int, leaf_rows: int) -> list[Tree]:
    """Trees for ``n`` vectors like the unit vectors ``points``; one leaf, where they fit into it."""
    depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(max(1, n) / leaf_rows)))))
    rng = np.random.default_rng(SEED)
    spill = spill_width(min_cosine, points.shape[1])
    return [Tree(points, depth, spill, rng) for _ in range(trees if depth else 1)]


def fit_forests(
    classes: DataFrame, kind: str, min_cosine: float, trees: int, leaf_rows: int
) -> dict[int, list[Tree]]:
    """A forest for each of the commonest lengths with more vectors than a leaf.

    The sample is shared among them.
    """
    widths = common_widths(classes, leaf_rows)
    return {
        width: build_forest(
            unit(sample_vectors(classes.filter(F.col("width") == width), SAMPLE // len(widths), kind)),
            n, min_cosine, trees, leaf_rows,
        )
        for width, n in widths.items()
    }


def _in_leaves(classes: DataFrame, forests: dict[int, list[Tree]], kind: str) -> DataFrame:
    """A row (width, place, key, v) for each leaf of each tree a vector goes to."""
    names = ["width", "place", "key", "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            apart = ~np.isin(widths, list(forests))
            rest = batch.take(pa.array(np.flatnonzero(apart)))
            yield pa.RecordBatch.from_arrays(
                [rest.column("width"), pa.array(np.zeros(len(rest), dtype=np.int64)),
                 rest.column("key"), rest.column("v")], names,
            )
            for width in np.unique(widths[~apart]).tolist():
                own = batch.take(pa.array(np.flatnonzero(widths == width)))
                points, forest = unit(matrix(own.column("v").to_pylist(), kind)), forests[width]
                for number, tree in enumerate(forest):
                    row, leaf = tree.leaves(points)
                    taken = own.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [taken.column("width"), pa.array(leaf * len(forest) + number),
                         taken.column("key"), taken.column("v")], names,
                    )

    return classes.select("width", "key", "v").mapInArrow(
        run, "width long, place long, key string, v binary"
    )


def _in_blocks(rows: DataFrame, group: list[str], block_rows: int) -> DataFrame:
    """``rows`` once for each pair of blocks (i, j) of its group, with its own block.

    Groups of up to ``block_rows`` rows are one block. Only larger ones are looked up.
    """
    large = (
        rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > block_rows)
        .select(*group, F.ceil(F.col("_rows") / block_rows).alias("_blocks"))
    )
    own = F.pmod(F.xxhash64("key"), F.coalesce("_blocks", F.lit(1)))
    others = F.sequence(F.lit(0).cast("long"), F.coalesce("_blocks", F.lit(1)) - 1)
    return (
        rows.join(large, group, "left")
        .withColumns({"own": own, "other": F.explode(others)})
        .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
        .drop("other", "_blocks")
    )


def _forest_links(points: np.ndarray, min_cosine: float) -> tuple[list[int], list[int]]:
    """Links that connect all rows that pairs at ``min_cosine`` or more connect, one per row.

    Grown from one row at a time; what is reached leaves the rest, so a dense group takes a
    few passes.
    """
    rest, left, right = np.arange(len(points)), [], []
    held = points
    while len(rest) > 1:
        root, queue = rest[0], [points[rest[0]]]
        rest, held = rest[1:], held[1:]
        while queue and len(rest):
            near = held @ queue.pop() >= min_cosine
            if near.any():
                got = rest[near]
                rest, held = rest[~near], held[~near]
                left += [root] * len(got)
                right += got.tolist()
                queue += list(points[got])
    return left, right


def _connect(rows: DataFrame, kind: str, min_cosine: float) -> DataFrame:
    """Links (u, v) between keys that meet."""
    import pandas as pd

    def run(group):
        points = unit(matrix(group["v"], kind))
        left, right = _forest_links(points, min_cosine)
        keys = group["key"].to_numpy()
        return pd.DataFrame({"u": keys[left], "v": keys[right]}, dtype=object)

    return rows.groupBy("width", "place", "i", "j").applyInPandas(run, "u string, v string")


def _count_links(rows: DataFrame, kind: str, min_cosine: float) -> DataFrame:
    """(key, links): vectors in the same component at ``min_cosine`` or more, by pairs of blocks."""
    import pandas as pd

    def run(group):
        a = group[group["own"] == group["i"]]
        same = group["i"].iloc[0] == group["j"].iloc[0]
        b = a if same else group[group["own"] == group["j"]]
        if not len(a) or not len(b):
            return pd.DataFrame({"key": [], "links": []}).astype({"links": "int64"})
        u, v = (unit(matrix(x["v"], kind)) for x in (a, b))
        n_u, n_v = (x["n"].to_numpy(dtype=np.int64) for x in (a, b))
        of_u, of_v = np.zeros(len(u), dtype=np.int64), np.zeros(len(v), dtype=np.int64)
        for at in range(0, len(u), 512):
            near = u[at : at + 512] @ v.T >= min_cosine
            if same:
                near[np.arange(len(near)), at + np.arange(len(near))] = False
            of_u[at : at + 512] = near @ n_v
            if not same:
                of_v += n_u[at : at + 512] @ near
        out = [pd.DataFrame({"key": a["key"], "links": of_u})]
        return pd.concat(out if same else [*out, pd.DataFrame({"key": b["key"], "links": of_v})])

    counted = rows.groupBy("root", "i", "j").applyInPandas(run, "key string, links long")
    return counted.groupBy("key").agg(F.sum("links").alias("links"))


def duplicate_vectors(
    table: DataFrame, min_cosine: float = MIN_COSINE, trees: int = TREES,
    leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per row of ``table`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    ``n_links`` counts the other vectors with a cosine of ``min_cosine`` or more in double
    precision, ``component_id`` is the smallest ``vec_id`` reachable by such links, ``kept``
    tells whether that is the row's own. Vectors that take no part (see
    :func:`~shelfstream.llm.vectors.packed_vectors`) have no links and are their own component.
    Vectors of different length do not link. Repeated rows link with each other. Other columns are ignored; no rows give no rows.
    """
    kind = vector_kind(table)
    packed = keep(packed_vectors(table), "vectors")
    classes = keep(
        packed.filter("key is not null").groupBy("key")
        .agg(F.first("v").alias("v"), F.first("width").alias("width"), F.count(F.lit(1)).alias("n"),
             F.min("vec_id").alias("first_id")),
        "classes",
    )
    forests = fit_forests(classes, kind, min_cosine, trees, leaf_rows)
    meeting = _in_blocks(_in_leaves(classes, forests, kind), ["width", "place"], block_rows)
    roots = components(_connect(meeting, kind, min_cosine)).withColumnsRenamed({"node": "key"})
    members = keep(classes.join(roots, "key"), "members")
    links = _count_links(_in_blocks(members, ["root"], block_rows), kind, min_cosine)
    least = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = (
        members.join(least, "root").join(links, "key").select("key", "links", "component_id")
    )
    per_class = classes.select("key", "n", "first_id").join(found, "key", "left").select(
        "key",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component_id", "first_id").alias("component_id"),
    )
    rows = packed.select("vec_id", "key").join(per_class, "key", "left")
    own = F.coalesce("component_id", "vec_id")
    return rows.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        own.alias("component_id"),
        F.col("vec_id").eqNullSafe(own).alias("kept"),
    )


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links and component."""
    return duplicate_vectors(read_table(spark, sf_dir, "embeddings"))
