"""Connected components of a large graph by alternating stars.

Both steps shuffle edges by a node and combine before they do, so a node with very many
neighbours is summed in place; adaptive execution splits it in the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstream.llm.common import keep


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node move to the least node next to it."""
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
        edges.select(F.col("v").alias("x"), F.col("u").alias("y"))
    )
    least = both.groupBy("x").agg(F.min("y").alias("_low"))
    return (
        both.filter("y > x")
        .join(least, "x")
        .select(F.col("y").alias("u"), F.least("x", "_low").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below move to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("_low"))
    moved = edges.join(least, "u").filter(F.col("v") != F.col("_low"))
    return (
        moved.select(F.col("v").alias("u"), F.col("_low").alias("v"))
        .unionByName(least.select("u", F.col("_low").alias("v")))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node that has an edge; ``root`` is the least node it reaches.

    ``edges`` has the columns ``u`` and ``v`` (bigint), in any direction, repeats and loops
    allowed; NULLs are ignored. Each round is written to the shared folder, so a lost
    executor costs a round at most. No edges give no rows.
    """
    current = keep(
        edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    mark = _mark(current)
    while mark[0]:
        after = keep(_small_star(_large_star(current)), "edges")
        before, mark = mark, _mark(after)
        current = after
        if mark == before:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
