"""The byte network: gradients, whole texts, held-out accuracy, edge cases."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from shelfstream.llm import language
from shelfstream.llm.language import (
    Network,
    fit_language,
    language_scores,
    op8_language,
    train,
)

TABLES = "/root/testdata/sf0.01"


def _fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


def _network(classes=3, hidden=4):
    rng = np.random.default_rng(0)
    return Network([f"l{i}" for i in range(classes)], language._new_direction(rng, hidden, classes),
                   language._new_direction(rng, hidden, classes),
                   rng.normal(size=classes).astype(np.float32))


def _slow_states(p, data):
    """One direction byte by byte: the logits after each."""
    hidden = p["h_state"].shape[0]
    h, out = np.zeros(hidden), []
    for b in data:
        gates = np.clip(p["x_gates"][b] + h @ p["h_gates"], 0, 1)
        state = np.clip(p["x_state"][b] + gates[hidden:] * (h @ p["h_state"]), -1, 1)
        h = (1 - gates[:hidden]) * state + gates[:hidden] * h
        out.append(h @ p["out"])
    return np.array(out)


def _slow_probabilities(net, raw):
    rows = []
    for at in range(0, len(raw), language.WINDOW):
        data = raw[at : at + language.WINDOW]
        logits = _slow_states(net.ahead, data) + _slow_states(net.back, data[::-1])[::-1] + net.bias
        rows.append(language._softmax(logits))
    return np.concatenate(rows)


def test_windows_equal_the_plain_recurrence():
    net = _network()
    texts = ["a", "hello é there", "x" * 255, "y z" * 86, "ab c" * 64, "long text " * 150]
    means = net.pool([*texts, ""])
    for text, row in zip(texts, means, strict=False):
        slow = _slow_probabilities(net, text.encode())
        assert np.allclose(row, slow.mean(axis=0), atol=1e-4)
        assert net.label_bytes(text) == [net.languages[c] for c in slow.argmax(axis=1)]
    assert (means[-1] == 0).all()


def test_a_text_longer_than_a_batch(monkeypatch):
    net = _network()
    monkeypatch.setattr(language, "WINDOWS_AT_ONCE", 3)
    text = "some words " * 400
    assert np.allclose(net.pool([text, "b"])[0], _slow_probabilities(net, text.encode()).mean(0), atol=1e-4)


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    p = {k: v.astype(np.float64) for k, v in language._new_direction(rng, 3, 2).items()}
    windows = rng.integers(0, 4, (7, 5))
    weight = rng.normal(size=(7, 5, 2))
    loss = lambda: float((language._train_pass(p, windows)[0] * weight).sum())
    out, kept = language._train_pass(p, windows)
    got = language._gradients(p, windows, kept, weight)
    for name, values in p.items():
        for _ in range(8):
            at = tuple(rng.integers(0, s) for s in values.shape)
            at = (at[0] % 4, *at[1:]) if name.startswith("x_") else at
            old = values[at]
            values[at] = old + 1e-5
            up = loss()
            values[at] = old - 1e-5
            down = loss()
            values[at] = old
            assert got[name][at] == pytest.approx((up - down) / 2e-5, abs=2e-3)


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}
    got = op8_language(spark, TABLES).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (_fold(r.doc_id) == 2) and 0 <= r.score <= 1 for r in got)
    right = [r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out]
    assert len(right) > 200 and np.mean(right) > 0.96


def test_held_out_languages_teach_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rows = [(r.doc_id, r.text, "zz" if _fold(r.doc_id) == 2 else r.lang) for r in docs.collect()]
    turned = spark.createDataFrame(rows, docs.schema)
    assert language._sample(docs, 20) == language._sample(turned, 20)


def test_strange_rows(spark):
    rows = [(1, None, "en", 1), (2, "", "en", 1), (3, " 123 !?", None, 1), (None, "the words", "fr", 1),
            (4, "the words", "en", 1), (4, "the words", "en", 1), (5, "le mot " * 90_000, "fr", 1),
            (7, "un mot", "fr", 1), (8, "ein wort", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    net = fit_language(docs)
    got = {(r.doc_id, r.lang_pred) for r in language_scores(docs, net).collect()}
    assert {lang for d, lang in got if d in (1, 2, 3)} == {"und"}
    assert {lang for d, lang in got if d not in (1, 2, 3)} <= {"en", "fr"}
    assert language_scores(docs, net).count() == len(rows)
    assert language_scores(docs.limit(0), net).collect() == []
    nothing = fit_language(docs.limit(0))
    assert {(r.lang_pred, r.score) for r in language_scores(docs, nothing).collect()} == {("und", 0.0)}


def test_one_language():
    net = train([("en", b"only one")])
    assert net.languages == ["en"] and net.pool(["text"])[0, 0] == pytest.approx(1)
