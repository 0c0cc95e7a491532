"""Vectors as bytes and matrices, and what the operators on them have in common."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstream.llm.common import share_by_hash


#: Lengths that get an index of their own at most, the commonest of those with enough vectors.
MAX_WIDTHS = 16


def packed_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, key, v, width) per row of ``table``.

    ``v`` holds the components as little-endian bytes, in their own precision, ``key`` a digest
    of them that equal vectors share, ``width`` is the number of components. Vectors of any
    length take part, each length in a space of its own. ``key`` and ``v`` are NULL where a
    vector takes no part: a NULL id, a vector that is NULL, empty or zero, and one with a NULL
    or not finite component.
    """
    kind = vector_kind(table, vec_col)
    vec = F.col(vec_col) if kind == "<f4" else F.col(vec_col).cast("array<double>")
    whole = F.when(~F.exists(vec, lambda x: x.isNull()), vec)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, valid = batch.column("v"), batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
            widths = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
            flat = flat + np.array(0, dtype=kind)  # one zero, without a sign
            starts = np.cumsum(widths) - widths
            raw: list[bytes | None] = [None] * batch.num_rows
            for width in np.unique(widths[widths > 0]).tolist():
                own = np.flatnonzero((widths == width) & valid)
                rows = flat[starts[own, None] + np.arange(width)]
                usable = np.isfinite(rows).all(axis=1) & (rows != 0).any(axis=1)
                for i, row in zip(own[usable].tolist(), rows[usable], strict=True):
                    raw[i] = row.tobytes()
            keys = [None if r is None else hashlib.blake2b(r, digest_size=16).hexdigest() for r in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(keys, pa.string()), pa.array(raw, pa.binary()),
                 pa.array(widths)],
                ["vec_id", "key", "v", "width"],
            )

    plain = table.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))
    return plain.mapInArrow(pack, "vec_id long, key string, v binary, width long")


def common_widths(packed: DataFrame, more_than: int) -> dict[int, int]:
    """Vectors of each length that more than ``more_than`` have, of ``MAX_WIDTHS`` lengths at most."""
    counts = packed.filter("key is not null").groupBy("width").agg(F.count(F.lit(1)).alias("n"))
    found = (
        counts.filter(F.col("n") > more_than).orderBy(F.desc("n"), F.desc("width")).limit(MAX_WIDTHS)
    )
    return {r.width: r.n for r in found.collect()}


def vector_kind(table: DataFrame, vec_col: str = "embedding") -> str:
    """The number format of ``v`` in :func:`packed_vectors`."""
    return "<f4" if table.schema[vec_col].dataType.elementType.typeName() == "float" else "<f8"


def matrix(raws, kind: str) -> np.ndarray:
    """Packed vectors of one length as rows of doubles."""
    raws = list(raws)
    if not raws:
        return np.zeros((0, 0))
    return np.frombuffer(b"".join(raws), dtype=kind).astype(np.float64).reshape(len(raws), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest component is divided out first, against overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def sample_vectors(packed: DataFrame, most: int, kind: str) -> np.ndarray:
    """About ``most`` different vectors, twice that at the very most, chosen by their digest."""
    n = packed.count()
    few = packed.filter(F.col("key").isNotNull() & share_by_hash(["key"], most, n))
    rows = few.groupBy("key").agg(F.first("v").alias("v")).limit(2 * most).collect()
    return matrix([r.v for r in sorted(rows, key=lambda r: r.key)], kind)
