"""Document quality: statistics, random Fourier features, ridge scores, isotonic calibration.

Each text is reduced to a few numbers once. Random Fourier features approximate a Gaussian
kernel over them, so that a linear fit is a kernel fit. Each partition sums its part of the
normal equations; the sums are added in groups, and one small system is solved. Other rows
give the scores a histogram, on which the pool of adjacent violators makes them probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream.llm.common import crc32_of_id, keep, read_table, small_batches, texts_of

FOURIER = 256
#: Width of the kernel, in standard deviations of the statistics.
WIDTH = 4.0
RIDGE = 1e-3
SCORE_BINS = 1024
THRESHOLD = 0.3
#: At most about this many labelled rows are fitted; beyond, those of least id hash are taken.
MAX_FIT_ROWS = 200_000
SEED = 7

FOLDS = 5
HELD_OUT = 0
_CALIBRATE = 4

STATISTICS = [
    "log_chars", "log_words", "mean_word", "sd_word", "long_words", "short_words", "letters",
    "digits", "spaces", "upper", "capital_words", "shouted_words", "other_signs", "ends_clean",
    "words_with_signs", "bar_words", "distinct_words", "top_word", "same_as_before",
    "distinct_lines", "log_lines", "line_words", "sentence_ends", "commas", "entropy",
    "not_ascii", "web_marks",
]
_SIGNS = re.compile(r"[^\w\s.,;:!?'\"()-]")
_SIGNED_WORD = re.compile(r"(?<!\S)\S*(?:[^\w\s.,;:!?'\"()-]|!!)\S*")
_WEB = re.compile(r"https?:|www\.|[{}<>=]|\\")


def statistics_of(text: str) -> list[float]:
    """The :data:`STATISTICS` of one text, all 0 for one without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    raw = text.encode("utf-8")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = len(raw)
    lower, upper = counts[97:123].sum(), counts[65:91].sum()
    digits, high = counts[48:58].sum(), counts[128:].sum()
    spaces = counts[32] + counts[9:14].sum()
    letters = lower + upper + high
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    kinds: dict[str, int] = {}
    for word in words:
        kinds[word] = kinds.get(word, 0) + 1
    lines = [line for line in text.split("\n") if line.strip()]
    share = counts[counts > 0] / size
    same = sum(map(str.__eq__, words, words[1:]))
    return [
        np.log1p(size), np.log1p(n), lengths.mean(), min(lengths.std(), 50.0),
        (lengths > 15).mean(), (lengths <= 3).mean(), letters / size,
        digits / size, spaces / size, upper / max(1, upper + lower),
        sum(map(str.istitle, words)) / n, sum(map(str.isupper, words)) / n,
        len(_SIGNS.findall(text)) / size, float(text.rstrip()[-1:] in ".!?\"')"),
        len(_SIGNED_WORD.findall(text)) / n, counts[124] / n,
        len(kinds) / n, max(kinds.values()) / n, same / n,
        len(set(lines)) / len(lines), np.log1p(len(lines)), np.log1p(n / len(lines)),
        (counts[46] + counts[33] + counts[63]) / n, counts[44] / n, float(-(share * np.log(share)).sum()),
        high / size, len(_WEB.findall(text)) / n,
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x array<double>) per row of ``docs``; a NULL text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 500):
            rows = np.array([statistics_of(t) for t in texts_of(batch, "text")], dtype=float)
            width = len(STATISTICS)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width), pa.array(rows.ravel())
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "x"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(run, "doc_id long, x array<double>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)


# ---------------------------------------------------------------- the model


@dataclass
class Model:
    """A fitted classifier: a few hundred numbers, whatever the data."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate([waves, np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.levels)


def pool_adjacent_violators(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values`` in weighted squares."""
    level: list[float] = []
    weight: list[float] = []
    length: list[int] = []
    for v, w in zip(values.tolist(), weights.tolist(), strict=True):
        level.append(v)
        weight.append(w)
        length.append(1)
        while len(level) > 1 and level[-2] >= level[-1]:
            v, w, n = level.pop(), weight.pop(), length.pop()
            level[-1] = (level[-1] * weight[-1] + v * w) / (weight[-1] + w)
            weight[-1] += w
            length[-1] += n
    return np.repeat(level, length)


_GROUPS = 64


def _sums(df: DataFrame, part_of, width: int) -> np.ndarray:
    """The sum over all rows of ``part_of(x, y)``, an array of ``width`` numbers.

    Each partition adds up its rows, :data:`_GROUPS` tasks add up partitions, and the driver
    those: what reaches it does not grow with the data.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += part_of(_matrix(batch), batch.column("y").to_numpy().astype(float))
        place = TaskContext.get().partitionId() % _GROUPS
        yield pa.RecordBatch.from_arrays([pa.array([place]), pa.array([total.tobytes()])], ["g", "s"])

    def add(group):
        import pandas as pd

        total = np.zeros(width)
        for raw in group["s"]:
            total += np.frombuffer(raw)
        return pd.DataFrame({"g": group["g"][:1], "s": [total.tobytes()]})

    parts = df.select("x", "y").mapInArrow(run, "g long, s binary")
    rows = parts.groupBy("g").applyInPandas(add, "g long, s binary").collect()
    # Each partial sum is exact to rounding; the order is fixed, so that reruns agree.
    return sum((np.frombuffer(r.s) for r in sorted(rows, key=lambda r: r.g)), np.zeros(width))


def fit(labelled: DataFrame) -> Model:
    """A model of ``labelled`` (doc_id, x, y): y 0 or 1, some rows set aside to calibrate.

    Rows with fold :data:`_CALIBRATE` calibrate, the others are fitted. Without rows of both
    labels every text scores the mean label, or 0.5 if there is none.
    """
    fold = crc32_of_id("doc_id") % FOLDS == _CALIBRATE
    train = labelled.filter(~F.coalesce(fold, F.lit(False)))
    check = labelled.filter(fold)
    width = len(STATISTICS)
    ones = _sums(train, lambda x, y: np.concatenate([[len(x), y.sum()], x.sum(0)]), 2 + width)
    n = max(1.0, ones[0])
    mean = ones[2:] / n
    var = _sums(train, lambda x, y: ((x - mean) ** 2).sum(0), width) / n
    rng = np.random.default_rng(SEED)
    model = Model(
        mean, np.sqrt(np.maximum(var, 1e-8)),
        rng.standard_normal((width, FOURIER)) / WIDTH, rng.uniform(0, 2 * np.pi, FOURIER),
        np.zeros(FOURIER + 1), np.array([0.0, 1.0]), np.full(2, ones[1] / n if ones[0] else 0.5),
    )
    if not 0 < ones[1] < ones[0]:
        return model
    size = FOURIER + 1

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.features(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums = _sums(train, normal, size * size + size)
    gram = sums[: size * size].reshape(size, size) / n
    model.weights = np.linalg.solve(gram + RIDGE * np.eye(size), sums[size * size :] / n)

    def histogram(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        bins = np.clip(((model.raw(x) + 0.5) / 2 * SCORE_BINS).astype(int), 0, SCORE_BINS - 1)
        return np.concatenate([np.bincount(bins, minlength=SCORE_BINS),
                               np.bincount(bins, weights=y, minlength=SCORE_BINS)])

    found = _sums(check, histogram, 2 * SCORE_BINS)
    total, good = found[:SCORE_BINS], found[SCORE_BINS:]
    seen = total > 0
    if not seen.any():  # nothing to calibrate on: the ridge score itself, cut to 0..1
        model.levels = np.array([0.0, 1.0])
        return model
    centres = (np.flatnonzero(seen) + 0.5) / SCORE_BINS * 2 - 0.5
    model.knots = centres
    model.levels = pool_adjacent_violators(good[seen] / total[seen], total[seen])
    return model


def scores(stats: DataFrame, model: Model) -> DataFrame:
    """``stats`` (doc_id, x) with the score of each row in place of ``x``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(model.score(_matrix(batch)))], ["doc_id", "score"]
                )

    return stats.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def _known(labels: DataFrame, max_rows: int) -> DataFrame:
    """(doc_id, y) of labels that may be learned, held-out ids left out; about ``max_rows`` at most."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
        .filter(F.col("y").isin(0, 1) & (crc32_of_id("doc_id") % FOLDS != HELD_OUT))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    n = known.count()
    if n > max_rows:
        places = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
        known = known.filter(places < int(max_rows / n * (1 << 30)))
    return known


def _labelled(stats: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """Statistics with their label, without held-out ids; about ``max_rows`` rows at most."""
    return stats.join(_known(labels, max_rows), "doc_id")


def quality_scores(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
    max_fit_rows: int = MAX_FIT_ROWS,
) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1: good).

    ``docs`` needs ``doc_id`` and ``text``, ``labels`` ``doc_id`` and ``quality``; nothing else
    is read. Labels are learned only of ids whose crc32 (as text) leaves a remainder other
    than 0 by 5; those that leave 0 are ``held_out``. Of several labels of an id the larger
    counts; NULL labels and ids, and labels other than 0 and 1, teach nothing. A NULL id is
    scored and not held out. Empty and NULL texts have all statistics 0 and the score that
    follows from them; very long texts are read whole. Repeated rows stay; an empty table gives
    an empty result.
    """
    stats = keep(document_statistics(docs), "statistics")
    fitted = keep(_labelled(stats, labels, max_fit_rows), "labelled")
    held_out = F.coalesce(crc32_of_id("doc_id") % FOLDS == HELD_OUT, F.lit(False))
    return scores(stats, fit(fitted)).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def fit_quality(docs: DataFrame, labels: DataFrame, max_fit_rows: int = MAX_FIT_ROWS) -> Model:
    """A model learned as in :func:`quality_scores`, to score rows of any table with.

    Only labelled documents are looked at. Their ids and labels, about ``max_fit_rows`` at most,
    are broadcast, 12 bytes each, so that no text is shuffled to find them.
    """
    known = F.broadcast(_known(labels, max_fit_rows))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(known.select("doc_id"), "doc_id")
    stats = keep(document_statistics(ids), "statistics")
    return fit(keep(stats.join(known, "doc_id"), "labelled"))


def good_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores ``threshold`` or more.

    A NULL text is an empty one; very long texts are read whole. Repeated rows stay or go
    together, other columns may have any name, and no rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 500):
            x = np.array([statistics_of(t) for t in texts_of(batch, "text")], dtype=float)
            yield batch.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    return quality_scores(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )
