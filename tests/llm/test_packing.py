"""Packing against a plain search, and what must hold of every result."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from shelfstream.llm.packing import CAPACITY, best_fit, op10_packing, pack_documents


def _slow_best_fit(pieces, capacity):
    """Looks at every bin for every piece."""
    bins, placed = [], []
    for length, source, cluster in pieces:
        fits = [
            (capacity - b["used"], k) for k, b in enumerate(bins)
            if capacity - b["used"] >= length
            and (source is None or source not in b["s"]) and (cluster is None or cluster not in b["c"])
        ]
        if fits:
            k = min(fits)[1]
        else:
            bins.append({"used": 0, "s": set(), "c": set()})
            k = len(bins) - 1
        placed.append((k, bins[k]["used"]))
        bins[k]["used"] += length
        bins[k]["s"] |= {source} - {None}
        bins[k]["c"] |= {cluster} - {None}
    return placed


@pytest.mark.parametrize("seed", range(12))
def test_equals_a_search_of_all_bins(seed):
    rng = random.Random(seed)
    pieces = [
        (rng.choice([0, 1, 50, 100, rng.randint(0, 100)]),
         rng.choice([None, "hot", "hot", *"abcdefgh"]), rng.choice([None, *range(60)]))
        for _ in range(300)
    ]
    if seed % 2:
        pieces.sort(key=lambda p: -p[0])
    assert best_fit(pieces, 100) == _slow_best_fit(pieces, 100)


def test_lengths_are_checked():
    with pytest.raises(ValueError):
        best_fit([(101, None, None)], 100)
    assert best_fit([], 100) == []


def _holds(rows, docs, capacity):
    """Every document whole and once, no bin too full, no conflict, no overlap."""
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    for own in bins.values():
        assert sum(r.length for r in own) <= capacity
        for kind in ("source", "cluster"):
            seen = Counter(getattr(r, kind) for r in own)
            assert all(n == 1 or value is None for value, n in seen.items())
        at = 0
        for r in sorted(own, key=lambda r: (r.offset, r.length)):
            assert r.offset == at
            at += r.length
    sizes = Counter()
    for r in rows:
        assert r.start == r.piece * capacity
        sizes[r.doc_id] += r.length
    want = Counter()
    for doc_id, text, *_ in docs:
        want[doc_id] += len((text or "").encode())
    assert dict(sizes) == dict(want)
    assert sum(r.piece == 0 for r in rows) == len(docs)
    return bins


ROWS = [(1, None, "s", 1), (2, "", "s", 1), (None, "no id", None, 1), (None, "no id", None, 1), (3, "x" * 2500, "s", 1),
        (4, "é" * 600, None, 1), (5, "same", "s", 1), (5, "same", "s", 1), (6, "same", "t", 1), (7, "y" * 100, "t", 1)]


@pytest.mark.parametrize("group_pieces", [4, 100])
def test_strange_rows(spark, group_pieces):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string, cluster int")
    rows = pack_documents(docs, capacity=100, group_pieces=group_pieces).collect()
    _holds(rows, ROWS, 100)
    assert pack_documents(docs.limit(0)).collect() == []


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = op10_packing(spark, sf_dir).collect()
    bins = _holds(rows, docs, CAPACITY)
    key = lambda r: (-r.length, r.doc_id, r.piece, r.source, r.cluster)
    groups = defaultdict(list)
    for r in sorted(rows, key=key):
        groups[r.bin_id >> 32].append(r)
    for own in groups.values():
        want = _slow_best_fit([(r.length, r.source, r.cluster) for r in own], CAPACITY)
        assert [(r.bin_id & 0xFFFFFFFF, r.offset) for r in own] == want
    hot = Counter(r.source for r in rows).most_common(1)[0][1]
    least = max(hot, sum(r.length for r in rows) / CAPACITY)
    assert len(bins) <= 1.25 * least


def test_equal_rows_are_dealt_evenly(spark):
    docs = spark.createDataFrame([(1, "a b", "s")] * 900, "doc_id long, text string, source string").repartition(3)
    rows = pack_documents(docs, group_pieces=100).collect()
    assert max(Counter(r.bin_id >> 32 for r in rows).values()) <= 130
    assert len({r.bin_id for r in rows}) == 900
