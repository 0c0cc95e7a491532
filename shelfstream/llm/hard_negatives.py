"""Hard negatives of anchor vectors by exact integer scores from residues.

Scores are inner products of integer vectors. They are computed modulo several small primes,
each a float32 matrix product of residues that stays below 2^24 and so is exact, and put
together by the Chinese remainder theorem; the number of primes follows from the longest
vector. Anchors meet all rows in tiles: a block of anchors and a part of the rows, both of
bounded size, dealt by a hash of the row's number. Each tile keeps an anchor's few best; a
window over those keeps the best of all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfstream.llm.common import keep, read_table

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: Negatives have at least this share of the positive's score, and at most all of it.
FLOOR_PERCENT = 80

#: Odd primes under 2^8: residues fit a byte, and products of a thousand of them 24 bits.
PRIMES = [251, 241, 239, 233, 229, 227, 223, 211]
_EXACT = 1 << 24
#: Scores are exact below this; a longer vector is an error.
MAX_SCORE = 1 << 55

#: Components of a block of anchors or of a part of the rows, at most, in expectation.
TILE_VALUES = 1 << 22
_LEAST_ROWS = 2_048
#: Scores held at a time.
_SCORES = 1 << 21


def primes_for(bound: int) -> list[int]:
    """So many primes that every score from ``-bound`` to ``bound`` has its own residues."""
    if bound >= MAX_SCORE:
        raise OverflowError(f"scores may reach {bound}; exact ones stay below {MAX_SCORE}")
    product, n = 1, 0
    while product <= 2 * bound:
        product *= PRIMES[n]
        n += 1
    return PRIMES[: max(1, n)]


def residues(rows: np.ndarray, prime: int) -> np.ndarray:
    """Integers modulo ``prime``, from -(prime-1)/2 to (prime-1)/2, as float32."""
    half = prime // 2
    return ((rows + half) % prime - half).astype(np.float32)


def product_modulo(left: np.ndarray, right: np.ndarray, prime: int) -> np.ndarray:
    """``left @ right.T`` of residues modulo ``prime``, as int64 from 0 on."""
    step = _EXACT // (prime // 2) ** 2
    total = np.zeros((len(left), len(right)), dtype=np.int64)
    for at in range(0, left.shape[1], step):
        total += (left[:, at : at + step] @ right[:, at : at + step].T).astype(np.int64)
    return total % prime


def exact_scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Signed inner products from the residues of both sides, one matrix for each prime.

    Mixed radix: each further prime adds one digit, so no number exceeds the primes' product.
    """
    value = product_modulo(left[0], right[0], primes[0])
    radix = primes[0]
    for a, b, prime in zip(left[1:], right[1:], primes[1:], strict=True):
        inverse = pow(radix, -1, prime)
        digit = (product_modulo(a, b, prime) - value % prime) * inverse % prime
        value += digit * radix
        radix *= prime
    return np.where(value > radix // 2, value - radix, value)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column as rows of integers."""
    flat = column.combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _best_positives(scores, ids, nulls, own, same) -> list[np.ndarray]:
    """Places of each anchor's best rows of its label, best first."""
    found = []
    for k in range(len(scores)):
        place = np.flatnonzero(same[k] & ~own[k])
        s = scores[k, place]
        if len(place) > 8 * POSITIVES:
            place = place[s >= np.partition(s, -POSITIVES)[-POSITIVES]]
            s = scores[k, place]
        found.append(place[np.lexsort((ids[place], nulls[place], -s))][:POSITIVES])
    return found


def _best_negatives(scores, ids, nulls, other, wanted) -> list[list[tuple[int, np.ndarray]]]:
    """For each anchor and each (number, score) wanted: the best places in its window."""
    found = []
    for k, positives in enumerate(wanted):
        windows = [(n, -(-FLOOR_PERCENT * s // 100), s) for n, s in positives]
        windows = [w for w in windows if w[1] <= w[2]]
        if not windows:
            found.append([])
            continue
        low, high = min(w[1] for w in windows), max(w[2] for w in windows)
        place = np.flatnonzero(other[k] & (scores[k] >= low) & (scores[k] <= high))
        place = place[np.lexsort((ids[place], nulls[place], -scores[k, place]))]
        s = -scores[k, place]
        ranges = [(n, *np.searchsorted(s, [-top, 1 - least])) for n, least, top in windows]
        found.append([(n, place[a : min(b, a + NEGATIVES)]) for n, a, b in ranges])
    return found


class _Tile:
    """A block of anchors against a part of the rows."""

    def __init__(self, anchors: pa.Table, rows: pa.Table, width: int, primes: list[int]):
        self.anchors, self.rows, self.primes = anchors, rows, primes
        self.left = [residues(_matrix(anchors.column("q"), width), p) for p in primes]
        self.right = [residues(_matrix(rows.column("q"), width), p) for p in primes]
        self.label, self.row = (rows.column(c).to_numpy() for c in ("label", "row"))
        ids = rows.column("vec_id")
        self.nulls = ids.is_null().to_numpy()
        self.ids = ids.fill_null(0).to_numpy()

    def parts(self):
        """(first anchor, scores, own, same label) for a few anchors at a time."""
        label, row = (self.anchors.column(c).to_numpy() for c in ("label", "row"))
        step = max(1, _SCORES // max(1, len(self.row)))
        for at in range(0, len(label), step):
            few = slice(at, at + step)
            scores = exact_scores([x[few] for x in self.left], self.right, self.primes)
            yield (
                at, scores, row[few, None] == self.row[None], label[few, None] == self.label[None]
            )


_POSITIVE = "a_row long, anchor_id long, positive_id long, positive_score long"
_NEGATIVE = (
    "a_row long, anchor_id long, number int, positive_id long, positive_score long, "
    "negative_id long, negative_score long"
)


def _positives_of(width: int, primes: list[int], anchors: pa.Table, rows: pa.Table) -> pa.Table:
    tile, out = _Tile(anchors, rows, width, primes), []
    for at, scores, own, same in tile.parts():
        for k, place in enumerate(_best_positives(scores, tile.ids, tile.nulls, own, same)):
            out.append((np.full(len(place), at + k), place, scores[k, place]))
    a, place, score = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in zip(*out, strict=True))
    return pa.table({
        "a_row": anchors.column("row").take(pa.array(a)),
        "anchor_id": anchors.column("vec_id").take(pa.array(a)),
        "positive_id": rows.column("vec_id").take(pa.array(place)),
        "positive_score": score,
    })


def _negatives_of(width: int, primes: list[int], anchors: pa.Table, rows: pa.Table) -> pa.Table:
    tile, out = _Tile(anchors, rows, width, primes), []
    positives = anchors.column("positives").to_pylist()
    for at, scores, _, same in tile.parts():
        wanted = [
            [(n, p["positive_score"]) for n, p in enumerate(x)] for x in positives[at : at + len(scores)]
        ]
        found = _best_negatives(scores, tile.ids, tile.nulls, ~same, wanted)
        for k, of_anchor in enumerate(found):
            for n, place in of_anchor:
                out.append((np.full(len(place), at + k), np.full(len(place), n), place, scores[k, place]))
    a, n, place, score = (
        (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, dtype=np.int64),) * 4
    )
    chosen = [positives[x][y] for x, y in zip(a.tolist(), n.tolist(), strict=True)]
    return pa.table({
        "a_row": anchors.column("row").take(pa.array(a)),
        "anchor_id": anchors.column("vec_id").take(pa.array(a)),
        "number": pa.array(n, pa.int32()),
        "positive_id": pa.array([p["positive_id"] for p in chosen], pa.int64()),
        "positive_score": pa.array([p["positive_score"] for p in chosen], pa.int64()),
        "negative_id": rows.column("vec_id").take(pa.array(place)),
        "negative_score": score,
    })


def _in_tiles(anchors: DataFrame, rows: DataFrame, blocks: int, parts: int, work, primes, schema: str) -> DataFrame:
    """``work`` on each pair of a block of ``anchors`` and a part of ``rows`` of one width."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    names = [f.split()[0] for f in schema.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32()}
    arrow = pa.schema([(n, types[f.split()[1]]) for n, f in zip(names, schema.split(", "), strict=True)])

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return arrow.empty_table()
        left = left.rename_columns([c.removeprefix("a_") for c in left.column_names])
        return work(key[0].as_py(), primes, left, right).cast(arrow)

    tile = ["width", "block", "part"]
    left = anchors.withColumn("block", dealt(blocks)).withColumn("part", every(parts))
    # Both sides come from one table; a cogroup tells columns of one name and origin not apart.
    left = left.withColumnsRenamed({c: f"a_{c}" for c in left.columns})
    right = rows.withColumn("part", dealt(parts)).withColumn("block", every(blocks))
    return (
        left.groupBy(*[f"a_{c}" for c in tile]).cogroup(right.groupBy(*tile)).applyInArrow(run, schema)
    )


def integer_vectors(table: DataFrame, vec_col: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; NULL for a vector that takes no part."""
    vec = F.col(vec_col).cast("array<double>")
    whole = ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(whole, F.transform(vec, lambda x: F.floor(x * scale)))


def mine_hard_negatives(
    table: DataFrame, label: Column, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding",
    tile_values: int = TILE_VALUES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``table`` has an id, a vector and what ``label`` and ``is_anchor`` are computed from. A
    row's score is its inner product with the anchor, both in 256ths, rounded down. An
    anchor's positives are its five best other rows of its label; for each of them its
    negatives are the five best rows of other labels with 80 to 100 % of the positive's
    score, ranked from 1. Equal scores are decided by the smaller id, a NULL id comes last.

    A NULL label, a NULL vector, and a vector with a NULL, infinite or NaN component take no
    part. Vectors of different length are not compared; empty ones have score 0 with each
    other. Every row is a row of its own: repeated ones are each other's positives, and
    anchors that repeat give their rows repeatedly. Other columns are ignored, and no rows
    give no rows. Where the largest squared length of a vector reaches 2^55, scores might
    not be exact and an ``OverflowError`` is raised.
    """
    q = integer_vectors(table, vec_col)
    usable = table.select(
        F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"), q.alias("q"),
    ).filter("label IS NOT NULL AND q IS NOT NULL")
    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    # Numbered and stored, so that a row is the same row in both passes and in any rerun.
    rows = keep(
        usable.withColumns({"width": F.size("q"), "square": square, "row": F.monotonically_increasing_id()}),
        "integers",
    )
    n, most, width, n_anchors = rows.agg(
        F.count(F.lit(1)), F.max("square"), F.max("width"), F.count_if("is_anchor")
    ).first()
    primes = primes_for(int((most or 0) * (1 + 1e-9)) + 1)
    most_rows = max(1, tile_values // max(1, width or 0))
    blocks = max(1, -(-n_anchors // most_rows))
    parts = max(1, -(-n // min(most_rows, max(_LEAST_ROWS, n // 64))))
    data = rows.select("vec_id", "label", "width", "row", "q")
    anchors = rows.filter("is_anchor").select(*data.columns)

    def best(found: DataFrame, of: list[str], score: str, other: str, most: int) -> DataFrame:
        order = Window.partitionBy(*of).orderBy(F.desc(score), F.asc_nulls_last(other))
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)

    near = _in_tiles(anchors, data, blocks, parts, _positives_of, primes, _POSITIVE)
    positives = (
        best(near, ["a_row"], "positive_score", "positive_id", POSITIVES)
        .groupBy("a_row")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("positives"))
        .withColumnRenamed("a_row", "row")
    )
    asked = keep(anchors.join(positives, "row"), "positives")
    found = _in_tiles(asked, data, blocks, parts, _negatives_of, primes, _NEGATIVE)
    return best(found, ["a_row", "number"], "negative_score", "negative_id", NEGATIVES).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh has the next label."""
    table = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(table, moved, F.col("vec_id") % 100 == 0)


OP12_SQL = f"""
WITH usable AS (SELECT vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * cast(x AS double))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    cast(list_dot_product(a.q, b.q) AS bigint) AS score
  FROM usable a JOIN usable b ON len(a.q) = len(b.q)
  WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}),
found AS (SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id,
    p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS rank
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND {FLOOR_PERCENT} * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, cast(rank AS int) AS rank, negative_id, positive_score, negative_score
FROM found WHERE rank <= {NEGATIVES}
"""
