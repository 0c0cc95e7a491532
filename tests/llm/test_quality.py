"""The classifier: held-out accuracy, calibration, whole texts, edge cases."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from shelfstream.llm import quality
from shelfstream.llm.quality import (
    STATISTICS,
    op5_quality,
    pool_adjacent_violators,
    quality_scores,
    statistics_of,
)


def _fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in op5_quality(spark, "/root/testdata/sf0.01").collect()}


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    held = [r for r in labels if _fold(r.doc_id) == 0]
    right = [scored[r.doc_id].predicted == r.quality for r in held]
    assert len(held) > 50 and np.mean(right) > 0.95


def test_every_document_has_a_score(spark, scored):
    ids = {r.doc_id for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert set(scored) == ids
    for r in scored.values():
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        assert r.held_out == (_fold(r.doc_id) == 0)


def test_held_out_labels_teach_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()]
    turned = [(d, 1 - q if _fold(d) == 0 else q) for d, q in rows]
    a, b = (
        quality_scores(docs, spark.createDataFrame(x, "doc_id long, quality int")).collect()
        for x in (rows, turned)
    )
    assert sorted(a) == sorted(b)


def test_pool_adjacent_violators_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(30):
        v, w = rng.integers(0, 6, 7).astype(float), rng.integers(1, 4, 7).astype(float)
        got = pool_adjacent_violators(v, w)
        want = [max(min(np.average(v[i : j + 1], weights=w[i : j + 1]) for j in range(k, 7))
                    for i in range(k + 1)) for k in range(7)]
        assert np.allclose(got, want) and (np.diff(got) >= -1e-12).all()


def test_normal_equations_are_summed_over_partitions(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=3).tolist(), int(rng.integers(0, 2))) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, x array<double>, y int").repartition(70)
    got = quality._sums(df, lambda x, y: np.concatenate([(x.T @ x).ravel(), x.T @ y]), 12)
    x, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    assert np.allclose(got, np.concatenate([(x.T @ x).ravel(), x.T @ y]))


def test_statistics_cover_the_whole_text():
    assert statistics_of("") == statistics_of(" \n") == [0.0] * len(STATISTICS)
    clean = "some plain words in a row. " * 2000
    assert statistics_of(clean + "!!! ### $$$ " * 2000) != statistics_of(clean)
    assert len(statistics_of("x")) == len(STATISTICS)


STRANGE = [(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "no id here.", "c"), (3, "word " * 300_000, "d"),
           (4, "\x00￿ 👍", "e")]


def test_strange_rows_without_labels(spark):
    docs = spark.createDataFrame(STRANGE, "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_scores(docs, none).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "2", "3", "4", "None"]
    assert {r.score for r in got} == {0.5}
    assert quality_scores(docs.limit(0), none).collect() == []


def test_strange_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60)
    rows = [(r.doc_id, i % 2) for i, r in enumerate(docs.collect())]
    labels = spark.createDataFrame(
        [*rows, *rows[:9], (None, 1), (1, None), (2, 7), (10**9, 1)], "doc_id long, quality int"
    )
    odd = spark.createDataFrame(STRANGE, "doc_id long, text string, q string").drop("q")
    got = quality_scores(docs.unionByName(odd), labels, max_fit_rows=30).collect()
    assert len(got) == 66 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) >= 1
