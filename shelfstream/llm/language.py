"""Language of a text by a bidirectional gated recurrent network over its bytes.

The network is trained here, in numpy, by backpropagation through time on a bounded sample.
It labels every byte of a text; the mean of the label probabilities is the document's. A text
is read in windows, in which both directions start anew, so its length bounds nothing. The
gates and the candidate state are piecewise linear, which makes a step a few vector
operations over thousands of windows at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream.llm.common import crc32_of_id, read_table, small_batches, texts_of

UNDETERMINED = "und"
FOLDS = 4
HELD_OUT = 2

HIDDEN = 8
WINDOW = 256
WINDOWS_AT_ONCE = 1024

#: The training sample: about this many documents of each language, this many windows of each.
FIT_DOCS = 1_000
FIT_WINDOWS = 4
FIT_BYTES = 64
FIT_STEPS = 300
FIT_BATCH = 256
RATE = 0.02
SEED = 11


# ---------------------------------------------------------------- the network


def _new_direction(rng, hidden: int, classes: int) -> dict[str, np.ndarray]:
    small = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    gates = small(256, 2 * hidden) * 0.3 + np.float32(0.5)
    return {
        "x_gates": gates,  # per byte: what it adds to the update and reset gates
        "x_state": small(256, hidden),  # and to the candidate state
        "h_gates": small(hidden, 2 * hidden) * np.float32(0.3),
        "h_state": small(hidden, hidden),
        "out": small(hidden, classes),
    }


def _logits(p: dict, windows: np.ndarray) -> np.ndarray:
    """Logits (step, window, class) of one direction over ``windows`` (step, window) of bytes."""
    steps, n = windows.shape
    hidden = p["h_state"].shape[0]
    out = np.empty((steps, n, p["out"].shape[1]), dtype=np.float32)
    h = np.zeros((n, hidden), dtype=np.float32)
    gates, gates_h = (np.empty((n, 2 * hidden), dtype=np.float32) for _ in range(2))
    state, state_h, update = (np.empty((n, hidden), dtype=np.float32) for _ in range(3))
    for t in range(steps):
        np.take(p["x_gates"], windows[t], axis=0, out=gates, mode="clip")
        np.take(p["x_state"], windows[t], axis=0, out=state, mode="clip")
        np.matmul(h, p["h_gates"], out=gates_h)
        np.matmul(h, p["h_state"], out=state_h)
        gates += gates_h
        np.maximum(gates, 0, out=gates)
        np.minimum(gates, 1, out=gates)
        state_h *= gates[:, hidden:]
        state += state_h
        np.maximum(state, -1, out=state)
        np.minimum(state, 1, out=state)
        np.subtract(h, state, out=update)
        update *= gates[:, :hidden]
        np.add(state, update, out=h)
        np.matmul(h, p["out"], out=out[t])
    return out


def _train_pass(p: dict, windows: np.ndarray) -> tuple[np.ndarray, list]:
    """As :func:`_logits`, with what the way back needs."""
    hidden = p["h_state"].shape[0]
    h = np.zeros((windows.shape[1], hidden), dtype=np.float32)
    out, kept = [], []
    for row in windows:
        raw = p["x_gates"][row] + h @ p["h_gates"]
        gates = np.clip(raw, 0, 1)
        z, r = gates[:, :hidden], gates[:, hidden:]
        inner = h @ p["h_state"]
        wide = p["x_state"][row] + r * inner
        state = np.clip(wide, -1, 1)
        kept.append((h, raw == gates, z, r, inner, wide == state, state))
        h = state + z * (h - state)
        out.append(h @ p["out"])
    kept.append(h)
    return np.stack(out), kept


def _by_byte(index: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` per byte."""
    order = np.argsort(index, kind="stable")
    found, start = np.unique(index[order], return_index=True)
    out = np.zeros((256, values.shape[1]), dtype=np.float32)
    out[found] = np.add.reduceat(values[order], start, axis=0)
    return out


def _gradients(p: dict, windows: np.ndarray, kept: list, d_out: np.ndarray) -> dict:
    """Backpropagation through time of one direction."""
    hidden = p["h_state"].shape[0]
    g = {k: np.zeros_like(v) for k, v in p.items()}
    d_h = np.zeros_like(kept[-1])
    gate_rows, state_rows = [], []
    after = kept[-1]
    for t in range(len(windows) - 1, -1, -1):
        h, open_gates, z, r, inner, open_state, state = kept[t]
        g["out"] += after.T @ d_out[t]
        d = d_h + d_out[t] @ p["out"].T
        d_state = d * (1 - z) * open_state
        d_inner = d_state * r
        d_gates = np.concatenate([d * (h - state), d_state * inner], axis=1) * open_gates
        d_h = d * z + d_inner @ p["h_state"].T + d_gates @ p["h_gates"].T
        g["h_state"] += h.T @ d_inner
        g["h_gates"] += h.T @ d_gates
        gate_rows.append(d_gates)
        state_rows.append(d_state)
        after = h
    index = windows[::-1].ravel()
    g["x_gates"] = _by_byte(index, np.concatenate(gate_rows))
    g["x_state"] = _by_byte(index, np.concatenate(state_rows))
    return g


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Network:
    """A trained network: two directions and the languages it knows."""

    languages: list[str]
    ahead: dict[str, np.ndarray]
    back: dict[str, np.ndarray]
    bias: np.ndarray

    def _windows(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Batches of (text number, length, bytes) of windows."""
        owner, length, held, n = [], [], [], 0
        for i, raw in enumerate(texts):
            data = np.frombuffer(raw, dtype=np.uint8)
            for at in range(0, len(data), WINDOW * WINDOWS_AT_ONCE):
                part = data[at : at + WINDOW * WINDOWS_AT_ONCE]
                k = -(-len(part) // WINDOW)
                rows = np.zeros(k * WINDOW, dtype=np.uint8)
                rows[: len(part)] = part
                sizes = np.full(k, WINDOW)
                sizes[-1] = len(part) - (k - 1) * WINDOW
                held.append(rows.reshape(k, WINDOW))
                owner.append(np.full(k, i))
                length.append(sizes)
                n += k
                if n >= WINDOWS_AT_ONCE:
                    yield np.concatenate(owner), np.concatenate(length), np.concatenate(held)
                    owner, length, held, n = [], [], [], 0
        if n:
            yield np.concatenate(owner), np.concatenate(length), np.concatenate(held)

    def _probabilities(self, length: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """(position, window, language); 0 beyond a window's length."""
        ragged = np.flatnonzero(length < WINDOW)
        turned = rows[:, ::-1].copy()
        for j in ragged:
            k = length[j]
            turned[j, :k] = rows[j, :k][::-1]
            turned[j, k:] = 0
        size = int(length.max())
        shape = lambda r: np.ascontiguousarray(r[:, :size].T).astype(np.intp)
        logits = _logits(self.ahead, shape(rows))
        behind = _logits(self.back, shape(turned))
        aligned = behind[::-1].copy()
        for j in ragged:
            k = length[j]
            aligned[:k, j] = behind[:k, j][::-1]
        logits += aligned
        logits += self.bias
        np.exp(np.clip(logits, -30, 30, out=logits), out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        for j in ragged:
            logits[length[j] :, j] = 0
        return logits

    def label_bytes(self, text: str) -> list[str]:
        """The language of each byte of a text."""
        out: list[str] = []
        for _, length, rows in self._windows([text.encode("utf-8")]):
            best = self._probabilities(length, rows).argmax(axis=2)
            for j, k in enumerate(length.tolist()):
                out += [self.languages[c] for c in best[:k, j]]
        return out

    def pool(self, texts: list[str]) -> np.ndarray:
        """Per text the mean probability of each language over its bytes."""
        raws = [t.encode("utf-8") for t in texts]
        total = np.zeros((len(texts), len(self.languages)))
        for owner, length, rows in self._windows(raws):
            sums = self._probabilities(length, rows).sum(axis=0, dtype=np.float64)
            np.add.at(total, owner, sums)
        return total / np.maximum(1, np.array([len(r) for r in raws]))[:, None]


def train(samples: list[tuple[str, bytes]], hidden: int = HIDDEN, steps: int = FIT_STEPS) -> Network:
    """A network from (language, bytes) windows; short ones are repeated to full length."""
    languages = sorted({lang for lang, _ in samples})
    rng = np.random.default_rng(SEED)
    k = len(languages)
    net = Network(languages, _new_direction(rng, hidden, k), _new_direction(rng, hidden, k),
                  np.zeros(k, dtype=np.float32))
    if k < 2:
        return net
    rows = np.stack([np.resize(np.frombuffer(raw, dtype=np.uint8), FIT_BYTES) for _, raw in samples])
    truth = np.array([languages.index(lang) for lang, _ in samples])
    per_class = [np.flatnonzero(truth == c) for c in range(k)]
    params = [*net.ahead.values(), *net.back.values(), net.bias]
    first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(c, max(1, FIT_BATCH // k)) for c in per_class])
        ahead = rows[pick].T.astype(np.intp)
        back = ahead[::-1]
        a_out, a_kept = _train_pass(net.ahead, ahead)
        b_out, b_kept = _train_pass(net.back, back)
        d = _softmax(a_out + b_out[::-1] + net.bias)
        d[:, np.arange(len(pick)), truth[pick]] -= 1
        d = (d / d.shape[1] / len(d)).astype(np.float32)
        g_a = _gradients(net.ahead, ahead, a_kept, d)
        g_b = _gradients(net.back, back, b_kept, d[::-1])
        grads = [*g_a.values(), *g_b.values(), d.sum(axis=(0, 1))]
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * (1 - step / (steps + 1)) / max(1.0, norm)
        for p, g, m, v in zip(params, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


# ---------------------------------------------------------------- operators


def _sample(docs: DataFrame, per_language: int) -> list[tuple[str, bytes]]:
    """Windows of about ``per_language`` documents of each language, those of least id hash."""
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter(
        F.col("lang").isNotNull() & (crc32_of_id("doc_id") % FOLDS != HELD_OUT)
        & (F.octet_length("text") > 0)
    )
    counts = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    bounds = F.create_map(*[
        F.lit(x) for lang, n in sorted(counts.items())
        for x in (lang, min(1 << 30, int(per_language / n * (1 << 30)) + 1))
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 500):
            langs, windows = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch, "text"), strict=True):
                raw = text.encode("utf-8")
                gap = max(1, (len(raw) - FIT_BYTES) // FIT_WINDOWS)
                for i in range(FIT_WINDOWS if len(raw) > FIT_BYTES else 1):
                    langs.append(lang)
                    windows.append(raw[i * gap : i * gap + FIT_BYTES])
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(windows, pa.binary())], ["lang", "raw"]
            )

    few = usable.filter(place < bounds[F.col("lang")]).select("lang", "text")
    rows = few.mapInArrow(cut, "lang string, raw binary").collect()
    return sorted((r.lang, bytes(r.raw)) for r in rows)


def fit_language(docs: DataFrame, per_language: int = FIT_DOCS) -> Network:
    """A network from ``docs`` (doc_id, text, lang), without held-out ids and NULL languages.

    The sample is bounded by ``per_language`` documents of each language, of which windows
    from the whole text are taken; the languages themselves are taken to be few.
    """
    return train(_sample(docs, per_language))


def _predict(network: Network, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The language of each text and its mean probability."""
    langs, best = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    known = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))]
    if known and network.languages:
        for i, row in zip(known, network.pool([texts[i] for i in known]), strict=True):
            c = int(row.argmax())
            langs[i], best[i] = network.languages[c], min(1.0, row[c])
    return langs, best


def documents_in(docs: DataFrame, network: Network, min_score: float) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is clear.

    Rejected are texts without a letter, NULL and empty ones too, and those whose best language
    has a mean probability under ``min_score``. Very long texts are read whole. Repeated rows
    stay or go together, other columns may have any name, and no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 500):
            langs, best = _predict(network, texts_of(batch, "text"))
            fine = [lang != UNDETERMINED for lang in langs]
            yield batch.filter(pa.array(np.array(fine) & (best >= min_score)))

    return docs.mapInArrow(run, docs.schema)


def language_scores(docs: DataFrame, network: Network) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (its mean probability).

    ``docs`` needs ``doc_id`` and ``text``; nothing else is read. A text that is NULL or has no
    letter is ``und`` with score 0, and so is every text if no language was learned. Of equally
    probable languages the first by name is predicted. Very long texts are read whole. A NULL id
    is not held out. Repeated rows stay; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 500):
            langs, best = _predict(network, texts_of(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs), pa.array(best)],
                ["doc_id", "lang_pred", "score"],
            )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held_out = F.coalesce(crc32_of_id("doc_id") % FOLDS == HELD_OUT, F.lit(False))
    found = plain.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return language_scores(docs, fit_language(docs))
