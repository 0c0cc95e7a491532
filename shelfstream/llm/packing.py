"""Best-fit packing of documents into sequences, with conflicts.

Documents longer than a sequence are cut. Pieces are dealt evenly to groups of a few thousand,
and each group is packed by itself, longest first: bins are kept in the order of the room they
have left and carry a bitmap of the sources and one of the duplicate clusters in them. The
search begins at the bin with the least room that is enough, and goes on to the next larger
until one holds neither the piece's source nor its cluster.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream.llm.common import keep, read_table
from shelfstream.llm.simhash import fingerprints, linked_fingerprints

#: Length of a sequence, in the unit of the documents' length.
CAPACITY = 8_192
#: Pieces packed together. A group's bins are closed to all others.
GROUP_PIECES = 4_096


def best_fit(
    pieces: list[tuple[int, object, object]], capacity: int
) -> list[tuple[int, int]]:
    """(bin, offset) of each (length, source, cluster), in the given order.

    No bin gets more than ``capacity``, two pieces of one source, or two of one cluster; None
    is no source and no cluster. Among the bins that may take a piece, the one with the least
    room left does, the older one if two have the same.
    """
    masks: dict[tuple, int] = {}
    order: list[tuple[int, int]] = []  # (room left, bin)
    sources: list[int] = []
    clusters: list[int] = []
    placed = []
    for length, source, cluster in pieces:
        if not 0 <= length <= capacity:
            raise ValueError(f"a piece of length {length}")
        s = 0 if source is None else masks.setdefault(("s", source), 1 << len(masks))
        c = 0 if cluster is None else masks.setdefault(("c", cluster), 1 << len(masks))
        at = bisect_left(order, (length, -1))
        while at < len(order) and (sources[order[at][1]] & s or clusters[order[at][1]] & c):
            at += 1
        if at < len(order):
            room, number = order.pop(at)
        else:
            room, number = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[number] |= s
        clusters[number] |= c
        insort(order, (room - length, number))
        placed.append((number, capacity - room))
    return placed


_PACKED = (
    "doc_id long, piece long, start long, length long, bin_id long, offset long, "
    "source string, cluster long"
)


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, length: Column | None = None,
    cluster: Column | None = None, group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: where in which bin (sequence) it goes.

    ``docs`` needs ``doc_id``, ``text`` and ``source``. ``length`` defaults to the bytes of the
    text, ``cluster`` to a hash of the text, so that copies never share a bin. A NULL or empty
    text is one piece of length 0. Piece ``piece`` of a document begins at ``start`` in it and
    at ``offset`` in its bin. A NULL source conflicts with no other; a cut document's pieces
    share its source, and without one its cluster, so each has a bin of its own. Repeated rows
    are packed as often as they occur; no rows give no rows.

    Only ids, lengths and hashes are shuffled, dealt evenly whatever their values, in an order
    that a repeated task finds again.
    """
    size = F.coalesce(length if length is not None else F.octet_length("text"), F.lit(0)).cast("long")
    same = cluster if cluster is not None else F.xxhash64("text")
    items = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        same.cast("long").alias("cluster"),
        size.alias("_size"),
    )
    last = F.greatest(F.ceil(F.col("_size") / capacity), F.lit(1)).cast("long") - 1
    pieces = items.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "doc_id",
        "piece",
        (F.col("piece") * capacity).alias("start"),
        F.least(F.lit(capacity), F.col("_size") - F.col("piece") * capacity).cast("long").alias("length"),
        "source",
        "cluster",
    )
    groups = max(1, -(-pieces.count() // group_pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        rows = table.to_pylist()
        first = ("length", "doc_id", "piece", "source", "cluster")
        rows.sort(key=lambda r: (-r["length"], *((r[k] is None, r[k] or 0) if k != "source" else
                                                 (r[k] is None, r[k] or "") for k in first[1:])))
        placed = best_fit([(r["length"], r["source"], r["cluster"]) for r in rows], capacity)
        base = TaskContext.get().partitionId() << 32
        for row, (number, offset) in zip(rows, placed, strict=True):
            row["bin_id"], row["offset"] = base + number, offset
        columns = [c.split() for c in _PACKED.split(", ")]
        schema = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in columns])
        yield pa.RecordBatch.from_pylist(rows, schema)

    return pieces.repartition(groups).mapInArrow(run, _PACKED)


def with_cluster(docs: DataFrame, carry: list[str]) -> DataFrame:
    """(doc_id, the columns ``carry``, cluster) per row of ``docs``, in no order.

    ``cluster`` is a number that near copies share (:mod:`.simhash`), a fingerprint of theirs.
    Texts are read once; what is carried along is joined by the fingerprint, and only with the
    fingerprints that have a link. A NULL text is an empty one; empty texts are copies.
    """
    marks = keep(fingerprints(docs, carry=carry), "marks")
    roots = linked_fingerprints(keep(marks.select("fp").distinct(), "fingerprints"))
    return marks.join(roots, "fp", "left").select(
        "doc_id", *carry, F.coalesce("root", "fp").alias("cluster")
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences that hold no two near copies."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", "text", F.octet_length("text").alias("size")
    )
    sized = keep(with_cluster(docs, ["source", "size"]), "clusters")
    return pack_documents(sized, length=F.col("size"), cluster=F.col("cluster"))
