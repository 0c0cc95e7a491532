"""Near-duplicates by fingerprints of word shingles, joined on a grid of segment counts.

A fingerprint of 64 bits is cut into 32 segments of two bits; its embedding is the number of
ones in each. The Manhattan distance of two embeddings never exceeds the number of bits in
which the fingerprints differ. So of two fingerprints that differ in 2r bits or fewer, one
half of the embedding (16 counts) differs by r or less, and then some grid point lies within
r/2 steps, rounded up, of both. Each fingerprint is sent to the grid points that near to its
two halves; those that meet at a point are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream.llm.common import free_name, keep, read_table, small_batches, texts_of
from shelfstream.llm.components import components

WORDS_PER_SHINGLE = 4
MAX_BITS = 4
#: Grid points with more fingerprints than this are compared in blocks by several tasks.
POINT_ROWS = 1 << 15

_SEED = 42
_HASHES_AT_ONCE = 1 << 15
_HALF = 0xFFFFFFFF
_ODD = 0x55555555
_SMALL = 24


# ---------------------------------------------------------------- fingerprints


def fingerprint_of(text: str, words_per_shingle: int = WORDS_PER_SHINGLE) -> int:
    """The fingerprint of one text, as an unsigned integer; 0 for a text without words."""
    from xxhash import xxh64_intdigest

    # Of bytes, lower() and split() know the letters A-Z and the bytes 20, 09-0D only.
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    ones, total = np.zeros(64, dtype=np.int64), 0
    n_shingles = max(1, len(words) - words_per_shingle + 1)
    for at in range(0, n_shingles, _HASHES_AT_ONCE):
        part = words[at : min(at + _HASHES_AT_ONCE, n_shingles) + words_per_shingle - 1]
        if len(words) < words_per_shingle:
            shingles = [b" ".join(words)]
        else:
            shingles = map(b" ".join, zip(*(part[i:] for i in range(words_per_shingle))))
        hashes = np.array([xxh64_intdigest(s, _SEED) for s in shingles], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(
    docs: DataFrame, words_per_shingle: int = WORDS_PER_SHINGLE, carry: list[str] | None = None
) -> DataFrame:
    """(doc_id, fp) per row, and the columns ``carry``; ``fp`` is the fingerprint as a signed bigint.

    ``docs`` needs ``doc_id`` and ``text``. A NULL or empty text has fingerprint zero. Long
    texts are hashed in blocks.
    """
    carry = carry or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1000):
            marks = [fingerprint_of(t, words_per_shingle) for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(marks, dtype="<u8").view("<i8")),
                 *[batch.column(c) for c in carry]],
                names=["doc_id", "fp", *carry],
            )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    more = "".join(f", {c} {plain.schema[c].dataType.simpleString()}" for c in carry)
    return plain.mapInArrow(run, f"doc_id long, fp long{more}")


# ---------------------------------------------------------------- the grid


def _counts(half: np.ndarray) -> np.ndarray:
    """Ones per two-bit segment of 32 bits, each count in the place of its segment."""
    return half - ((half >> 1) & _ODD)


def _steps(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each direction: which points have a neighbour there, and that neighbour."""
    for segment in range(16):
        count = (points >> (2 * segment)) & 3
        step = 1 << (2 * segment)
        yield count < 2, points + step
        yield count > 0, points - step


def _grid_points(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(grid point, fingerprint) rows: all points within ``radius`` of either half."""
    cells, owners = [], []
    for half in (0, 1):
        start = _counts((fps >> (32 * half)) & _HALF)
        seen, who = start, np.arange(len(fps))
        for _ in range(radius):
            more, of = [seen], [who]
            for ok, there in _steps(seen):
                more.append(there[ok])
                of.append(who[ok])
            rows = np.unique(
                np.stack([np.concatenate(of), np.concatenate(more)], axis=1), axis=0
            ) if radius > 1 else np.stack([np.concatenate(of), np.concatenate(more)], axis=1)
            who, seen = rows[:, 0], rows[:, 1]
        cells.append(seen | (half << 32))
        owners.append(fps[who])
    return np.concatenate(cells), np.concatenate(owners)


def _to_grid(distinct: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 5000):
            cells, owners = _grid_points(batch.column("fp").to_numpy(), radius)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(owners)], ["cell", "fp"])

    return distinct.select("fp").mapInArrow(run, "cell long, fp long")


def _bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def _meets_here(cell: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a pair is to be reported at this grid point, of the several where it meets.

    Exact for a radius of one: the point is the least of those next to both, in the first
    half that is near enough.
    """
    half = cell >> 32
    x, y = (_counts((v >> (32 * half)) & _HALF) for v in (a, b))
    differ = x ^ y
    lowest = differ & -differ
    place = np.where(differ == 0, 0, np.bitwise_count((lowest - 1).view(np.uint64)) // 2 * 2)
    place = place.astype(np.int64)
    mask = np.where(differ == 0, 0, np.int64(3) << place)
    first, second = (x & ~mask) | (y & mask), (y & ~mask) | (x & mask)
    # One segment that differs by two: the point between.
    between = (differ & ~mask) == 0
    between &= np.abs(((x >> place) & 3) - ((y >> place) & 3)) == 2
    here = np.where(between, (x & ~mask) | (np.int64(1) << place), np.minimum(first, second))
    x0, y0 = (_counts(v & _HALF) for v in (a, b))
    apart0 = np.zeros(len(a), dtype=np.int64)
    for segment in range(0, 32, 2):
        apart0 += np.abs(((x0 >> segment) & 3) - ((y0 >> segment) & 3))
    return (here == (cell & _HALF)) & ((half == 0) | (apart0 > 2))


def _forest(fps: np.ndarray, max_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that connect all of ``fps`` that pairs within ``max_bits`` connect, one per row.

    Grown from one fingerprint at a time; what is reached leaves the rest, so a dense group
    of any size takes a few passes and its pairs are never listed.
    """
    rest, left, right = np.unique(fps), [], []
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        queue = [root]
        while queue and len(rest):
            near = _bits_apart(rest, np.full(1, queue.pop())) <= max_bits
            if near.any():
                got = rest[near]
                rest = rest[~near]
                left.append(np.full(len(got), root))
                right.append(got)
                queue.extend(got)
    return left, right


def _links_of(cells: np.ndarray, fps: np.ndarray, max_bits: int, exact_once: bool):
    """Links among rows sorted by grid point, of whole points."""
    starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
    sizes = np.diff(np.append(starts, len(cells)))
    left, right = [], []
    for start, size in zip(starts[sizes > _SMALL], sizes[sizes > _SMALL], strict=True):
        more = _forest(fps[start : start + size], max_bits)
        left += more[0]
        right += more[1]
    small = np.repeat((sizes > 1) & (sizes <= _SMALL), sizes)
    cells, fps = cells[small], fps[small]
    for shift in range(1, _SMALL):
        same = cells[shift:] == cells[:-shift]
        if not same.any():
            break
        a, b, at = fps[:-shift][same], fps[shift:][same], cells[shift:][same]
        near = _bits_apart(a, b) <= max_bits
        a, b, at = a[near], b[near], at[near]
        if exact_once:
            once = _meets_here(at, a, b)
            a, b = a[once], b[once]
        left.append(a)
        right.append(b)
    return left, right


def _batch(left: list, right: list, waits: bool) -> pa.RecordBatch:
    u, v = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (left, right))
    return pa.RecordBatch.from_arrays(
        [pa.array(u), pa.array(v), pa.array(np.full(len(u), waits))], ["u", "v", "waits"]
    )


def _meet(grid: DataFrame, max_bits: int, radius: int, point_rows: int) -> DataFrame:
    """Links (u, v), and the rows (point, fingerprint) of points too full for one task.

    A task holds a batch and at most ``point_rows`` rows of the point it is in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = fps = np.zeros(0, dtype=np.int64)
        full = None  # the point whose rows are passed on
        for batch in batches:
            cells = np.concatenate([cells, batch.column("cell").to_numpy()])
            fps = np.concatenate([fps, batch.column("fp").to_numpy()])
            if full is not None:
                n = int(np.searchsorted(cells, full, "right"))
                yield _batch([cells[:n]], [fps[:n]], True)
                cells, fps = cells[n:], fps[n:]
            if not len(cells):
                continue
            last = int(np.searchsorted(cells, cells[-1], "left"))
            yield _batch(*_links_of(cells[:last], fps[:last], max_bits, radius == 1), False)
            cells, fps = cells[last:], fps[last:]
            full = None
            if len(cells) > point_rows:
                full = cells[0]
                yield _batch([cells], [fps], True)
                cells = fps = np.zeros(0, dtype=np.int64)
        if len(cells):
            yield _batch(*_links_of(cells, fps, max_bits, radius == 1), False)

    dealt = grid.repartition("cell").sortWithinPartitions("cell", "fp")
    return dealt.mapInArrow(run, "u long, v long, waits boolean")


def _meet_in_blocks(waiting: DataFrame, max_bits: int, point_rows: int) -> DataFrame:
    """Links of the full points: each pair of blocks of a point is a group of its own."""
    blocks = waiting.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / point_rows).alias("n"))
    own = F.pmod(F.xxhash64("fp"), F.col("n"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
    pairs = (
        waiting.join(blocks, "cell")
        .select("cell", "fp", own.alias("own"), other.alias("other"))
        .select("cell", "fp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )

    def run(group):
        import pandas as pd

        left, right = _forest(group["fp"].to_numpy(), max_bits)
        if not left:
            return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        return pd.DataFrame({"u": np.concatenate(left), "v": np.concatenate(right)})

    return pairs.groupBy("cell", "i", "j").applyInPandas(run, "u long, v long")


def linked_fingerprints(
    distinct: DataFrame, max_bits: int = MAX_BITS, point_rows: int = POINT_ROWS
) -> DataFrame:
    """(fp, root) for each of the different fingerprints ``distinct`` (fp) that has a link.

    Fingerprints that differ in ``max_bits`` bits or fewer are linked; those that reach each
    other have the same root, one of them.
    """
    if not 0 <= max_bits <= 8:
        raise ValueError("max_bits from 0 to 8")
    radius = (max_bits // 2 + 1) // 2
    found = keep(_meet(_to_grid(distinct, radius), max_bits, radius, point_rows), "links")
    links = found.filter(~F.col("waits")).select("u", "v")
    waiting = found.filter("waits").select(F.col("u").alias("cell"), F.col("v").alias("fp"))
    if not waiting.isEmpty():
        links = links.unionByName(_meet_in_blocks(waiting, max_bits, point_rows))
    return components(links).withColumnsRenamed({"node": "fp"})


def fingerprint_groups(
    marks: DataFrame, max_bits: int = MAX_BITS, point_rows: int = POINT_ROWS
) -> DataFrame:
    """(fp, component_id) per distinct fingerprint of ``marks`` (doc_id, fp).

    Fingerprints that differ in ``max_bits`` bits or fewer are linked; ``component_id`` is the
    smallest ``doc_id`` of the documents reachable. Copies are reduced to one row before the
    first shuffle and never listed as pairs.
    """
    distinct = keep(marks.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    roots = linked_fingerprints(distinct, max_bits, point_rows)
    rooted = distinct.join(roots, "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def simhash_groups(
    docs: DataFrame, words_per_shingle: int = WORDS_PER_SHINGLE, max_bits: int = MAX_BITS,
    point_rows: int = POINT_ROWS,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Repeated rows stay
    repeated. A NULL id is never the smallest; a group of NULL ids alone has a NULL component.
    Texts without words share fingerprint zero and are linked like any other. An empty table
    gives an empty result.
    """
    marks = keep(fingerprints(docs, words_per_shingle), "marks")
    groups = fingerprint_groups(marks, max_bits, point_rows)
    return marks.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_group(
    docs: DataFrame, words_per_shingle: int = WORDS_PER_SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stand for their group.

    Of each group the row with the smallest ``doc_id`` stays, one of several with that id, and
    one with a NULL id only if there is no other. ``docs`` must be read from files, so that its
    rows come in the same order whenever they are read.
    """
    row = free_name(docs, "_row")
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    marks = keep(
        fingerprints(rows.select(F.col(row).alias("doc_id"), "text"), words_per_shingle), "marks"
    )
    groups = fingerprint_groups(marks, max_bits)
    ids = rows.select(F.col(row).alias("_at"), F.col("doc_id").cast("long").alias("_id"))
    order = F.struct(F.col("_id").isNull(), "_id", "_at")
    first = (
        marks.join(groups, "fp").withColumnRenamed("doc_id", "_at").join(ids, "_at")
        .groupBy("component_id").agg(F.min(order).alias("first"))
        .select(F.col("first._at").alias(row))
    )
    return rows.join(first, row, "left_semi").select(*docs.columns)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and group."""
    return simhash_groups(read_table(spark, sf_dir, "documents"))
