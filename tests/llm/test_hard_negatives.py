"""Hard negatives against plain integer arithmetic."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from check_oracle import connect, rows_of, rows_of_sql

from shelfstream.llm import hard_negatives
from shelfstream.llm.hard_negatives import (
    OP12_SQL, PRIMES, exact_scores, mine_hard_negatives, op12_hard_negatives, primes_for, residues,
)

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, q int, row string"


def _slow(rows):
    def usable(r):
        return r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])

    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in filter(usable, rows)]
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for k, (anchor, a, label) in enumerate(kept):
        if anchor is None or anchor % 10:
            continue
        scored = [
            (sum(x * y for x, y in zip(a, v, strict=True)), i, other == label)
            for n, (i, v, other) in enumerate(kept) if n != k and len(v) == len(a)
        ]
        for s, p, _ in sorted((x for x in scored if x[2]), key=order)[:5]:
            near = sorted((x for x in scored if not x[2] and 80 * s <= 100 * x[0] <= 100 * s), key=order)
            out += [(anchor, p, n + 1, x[1], s, x[0]) for n, x in enumerate(near[:5])]
    return sorted(out, key=str)


def _mined(spark, rows, **options):
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(4)
    return mine_hard_negatives(table, F.col("label"), F.col("vec_id") % 10 == 0, **options)


def _rows(seed, n=260, dim=12, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim)) * 0.3
    return [
        (int(i), [float(np.float32(x)) for x in centres[rng.integers(6)] + rng.normal(size=dim) * 0.05],
         int(rng.integers(labels)))
        for i in rng.permutation(n)
    ]


@pytest.mark.parametrize("options", [{}, {"tile_values": 12 * 9}, {"tile_values": 12 * 50}])
def test_equals_plain_arithmetic(spark, options, monkeypatch):
    monkeypatch.setattr(hard_negatives, "_LEAST_ROWS", 16)
    rows = _rows(1)
    want = _slow(rows)
    assert len(want) > 300
    got = _mined(spark, rows, **options)
    assert got.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_ties_repeats_nulls_and_lengths(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "_LEAST_ROWS", 4)
    v, w = [0.5, 0.25, -0.1], [0.5, 0.25, -0.11]
    rows = [(n, v, n % 3) for n in range(40)] + [(n, w, n % 2) for n in range(40, 60)]
    rows += [(10, v, 1), (10, v, 1), (None, v, 0), (None, w, 1), (None, None, None)]
    rows += [(70, None, 1), (80, v, None), (90, [0.1, None, 0.2], 1), (100, [math.nan, 0.0, 1.0], 1)]
    rows += [(110, [math.inf, 0.0, 1.0], 2), (120, [], 0), (121, [], 0), (122, [], 1), (130, [0.5], 0), (131, [0.4], 0)]
    rows += [(140, [0.0, 0.0, 0.0], 0), (150, [-0.5, -0.25, 0.1], 2)]
    got = _mined(spark, rows)
    assert sorted(map(tuple, got.collect()), key=str) == _slow(rows)


def test_no_rows_no_anchors_one_label(spark):
    assert _mined(spark, []).collect() == []
    assert _mined(spark, [(1, [0.5], 0), (2, [0.5], 1)]).collect() == []
    assert _mined(spark, [(10, [0.5], 0), (2, [0.5], 0)]).collect() == []


@pytest.mark.parametrize("size, dim", [(3, 5), (200, 64), (30_000, 3_000), (10**6, 100)])
def test_scores_are_exact(size, dim):
    rng = np.random.default_rng(size)
    a, b = (rng.integers(-size, size + 1, (n, dim)) for n in (7, 9))
    a[0], b[0], b[1] = size, size, -size
    primes = primes_for(size * size * dim)
    got = exact_scores([residues(a, p) for p in primes], [residues(b, p) for p in primes], primes)
    assert (got == a @ b.T).all()


def test_primes():
    assert all(all(p % d for d in range(2, p)) for p in PRIMES)
    assert math.prod(PRIMES) > 2 * hard_negatives.MAX_SCORE
    with pytest.raises(OverflowError):
        primes_for(1 << 60)


def test_query_equals_sql(spark, sf_dir):
    assert rows_of(op12_hard_negatives(spark, sf_dir)) == rows_of_sql(connect(sf_dir), OP12_SQL)
