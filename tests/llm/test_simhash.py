"""Fingerprints and their groups against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from shelfstream.llm import simhash
from shelfstream.llm.components import components
from shelfstream.llm.simhash import fingerprint_groups, fingerprint_of, op2_simhash, simhash_groups


def _slow_fingerprint(text, k=4):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _slow_groups(rows, max_bits):
    """rows: (doc_id, unsigned fingerprint). The component of each row."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= max_bits:
                parent[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)] = min(ids.get(find(i), doc_id), doc_id)
    return [ids.get(find(i)) for i in range(len(rows))]


@pytest.mark.parametrize("text", [
    "", " \t\n", "One", "one TWO three", "a b c d", "a b c d e É ß İ", "x y z　w v\x1cu\x85t",
    "a b c d " * 40, "Ä" * 50,
])
def test_fingerprint_of_small_texts(text):
    assert fingerprint_of(text) == _slow_fingerprint(text)


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    text = " ".join(str(i * i % 97) for i in range(500))
    monkeypatch.setattr(simhash, "_HASHES_AT_ONCE", 7)
    assert fingerprint_of(text) == _slow_fingerprint(text)


def _near_marks(seed, n=220):
    """Fingerprints with many at each distance from 0 to 8 of each other."""
    rng = random.Random(seed)
    made = [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    while len(made) < n:
        base = rng.choice(made)
        for bit in rng.sample(range(64), rng.randint(0, 8)):
            base ^= 1 << bit
        made.append(base)
    return [(rng.randint(0, 10**6) if rng.random() > 0.03 else None, m) for m in made]


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 4, 6])
def test_groups_equal_brute_force(spark, max_bits):
    rows = _near_marks(max_bits)
    marks = spark.createDataFrame([(d, _signed(m)) for d, m in rows], "doc_id long, fp long")
    groups = {r.fp: r.component_id for r in fingerprint_groups(marks, max_bits).collect()}
    assert [groups[_signed(m)] for _, m in rows] == _slow_groups(rows, max_bits)


def test_full_points_are_compared_in_blocks(spark):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    rows = [(i, base ^ sum(1 << b for b in rng.sample(range(40), 3))) for i in range(250)]
    marks = spark.createDataFrame([(d, _signed(m)) for d, m in rows], "doc_id long, fp long")
    groups = {r.fp: r.component_id for r in fingerprint_groups(marks, 4, point_rows=20).collect()}
    assert [groups[_signed(m)] for _, m in rows] == _slow_groups(rows, 4)


def test_forest_connects_what_pairs_connect():
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 12, 300).astype(np.int64)
    left, right = simhash._forest(fps, 2)
    rows = [(int(f), int(f)) for f in np.unique(fps)]
    slow = dict(zip([r[0] for r in rows], _slow_groups(rows, 2), strict=True))
    edges = list(zip(np.concatenate(left).tolist(), np.concatenate(right).tolist(), strict=True))
    assert all(slow[a] == slow[b] for a, b in edges)
    assert len(edges) == len(slow) - len(set(slow.values()))


def test_strange_rows(spark):
    words = "the same words in each of these texts but for one at the end of it".split()
    rows = [(5, None, "x"), (7, "", "y"), (7, "", "y"), (None, " \n", "z"), (None, "lonely text", ""),
            (1, " ".join(words), ""), (2, " ".join(words).upper(), ""), (3, "\t".join(words), "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash_groups(docs).collect()
    want = [(d, _slow_fingerprint(t)) for d, t, _ in rows]
    comps = _slow_groups(want, 4)
    key = lambda r: str(r)
    assert sorted([tuple(r) for r in got], key=key) == sorted(
        [(d, f"{m:016x}", c) for (d, m), c in zip(want, comps, strict=True)], key=key
    )
    assert simhash_groups(docs.limit(0)).collect() == []


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = [(d.doc_id, _slow_fingerprint(d.text)) for d in docs]
    want = {(d, f"{m:016x}", c) for (d, m), c in zip(rows, _slow_groups(rows, 4), strict=True)}
    assert {tuple(r) for r in op2_simhash(spark, sf_dir).collect()} == want


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, 1000 + i) for i in range(50)] + [(1000, 3)]
    edges = spark.createDataFrame([*chain, *star, (5, 5), (9, 8), (8, 9), (None, 1)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    want = dict.fromkeys(range(100, 141), 100) | {8: 8, 9: 8, 7: 3, 3: 3}
    want |= dict.fromkeys(range(1000, 1050), 3)
    assert got == want
    assert components(edges.filter(F.lit(False))).collect() == []
