"""Quality classifier: naive Bayes support vectors over n-gram indicators.

Features of a text are indicators of its byte trigrams and of n-grams of word
shapes (classes of the first, second and last byte, and whether the word repeats
one of the two before), hashed into a fixed number of slots.  Each slot is scaled
by its log-count ratio between the classes, rows are brought to unit length, and
a linear model with squared hinge loss is fitted by dual coordinate descent.  A
sigmoid fitted to the margins of training rows that the descent did not see
turns margins into scores.

Only the fit is bounded: it takes the ``SAMPLE`` labelled rows with the smallest
hash of their id, which is why they may be broadcast to the scan of the texts
and meet in one task.  Scoring maps over all whole texts, without a shuffle; the
model has a fixed size.

Defined results: null and empty texts have no features and get the score of the
intercept.  Rows whose labels contradict each other are not learned from.  With
labels of one class only, every score is the smoothed share of class 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.llm.words import Block, Words, blocks, split, word_hashes

SAMPLE = 16_000
FOLDS = 5
THRESHOLD = 0.3
GRAM_BITS = 16
SLOTS = 2 << GRAM_BITS  # the first half for trigrams, the second for shapes
SMOOTHING = 1.0
COST = 1.0
ROUNDS = 12
CALIBRATION = 5  # every fifth row of the sample

MODEL_SCHEMA = "weights binary, squares binary, intercept double, slope double, shift double"

_CLASS = np.full(256, 3, np.uint32)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[128:] = 4


class Model(NamedTuple):
    weights: np.ndarray  # of a slot, already times its log-count ratio
    squares: np.ndarray  # of the log-count ratio
    intercept: float
    slope: float
    shift: float

    def score(self, slots: np.ndarray) -> float:
        length = float(np.sqrt(self.squares[slots].sum())) if len(slots) else 0.0
        margin = self.intercept + (float(self.weights[slots].sum()) / length if length else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30))))


def in_slots(codes: np.ndarray) -> np.ndarray:
    """32-bit codes into 2 ** GRAM_BITS slots."""
    codes = codes * np.uint32(0x9E3779B1)
    codes ^= codes >> np.uint32(15)
    return (codes * np.uint32(0x85EBCA77)) >> np.uint32(32 - GRAM_BITS)


def trigrams(data: np.ndarray) -> np.ndarray:
    if len(data) < 3:
        return np.zeros(0, np.uint32)
    d = data.astype(np.uint32)
    return in_slots(d[:-2] | d[1:-1] << np.uint32(8) | d[2:] << np.uint32(16))


def shapes(block: Block, words: Words) -> np.ndarray:
    """A small number for each word of a block."""
    data, starts, ends = block.data, words.starts, words.ends
    hashes = word_hashes(data, words)
    again = np.zeros(len(starts), np.uint32)
    again[1:] |= hashes[1:] == hashes[:-1]
    again[2:] |= (hashes[2:] == hashes[:-2]) * np.uint32(2)
    second = np.minimum(starts + 1, ends - 1)
    # Punctuation counts as itself at the end of a word.
    end = np.where(_CLASS[data[ends - 1]] == 3, data[ends - 1].astype(np.uint32) + 8, _CLASS[data[ends - 1]])
    before = _CLASS[data[np.maximum(ends - 2, starts)]]
    return (((_CLASS[data[starts]] * 5 + _CLASS[data[second]]) * 5 + before) * 256 + end) * 4 + again


def row_slots(block: Block) -> Iterator[np.ndarray]:
    """The distinct slots of each row's features, ascending."""
    grams, words = trigrams(block.data), split(block)
    shape = shapes(block, words) + np.uint32(1)
    pair = shape[:-1] * np.uint32(65599) + shape[1:]
    triple = pair[:-1] * np.uint32(65599) + shape[2:]
    ones, twos, threes = in_slots(shape), in_slots(pair ^ np.uint32(0x55555555)), in_slots(triple ^ np.uint32(0x33333333))
    seen = np.zeros(SLOTS, bool)
    half = seen[1 << GRAM_BITS :]
    for a, b, i, j in zip(block.bounds[:-1], block.bounds[1:], words.bounds[:-1], words.bounds[1:], strict=True):
        seen[grams[a : max(a, b - 2)]] = True
        half[ones[i:j]] = True
        half[twos[i : max(i, j - 1)]] = True
        half[threes[i : max(i, j - 2)]] = True
        slots = np.flatnonzero(seen)
        seen[slots] = False
        yield slots


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = np.zeros((2, SLOTS))
    for slots, label in zip(rows, labels, strict=True):
        counts[label, slots] += 1
    shares = counts + SMOOTHING
    shares /= shares.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def descend(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the squared hinge loss; weights and intercept.

    Classes weigh alike in the sum of losses.  The intercept is the weight of one
    more feature that is always 1.
    """
    sign = np.where(labels == 1, 1.0, -1.0)
    cost = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9)) * COST
    values = [ratios[s] / max(float(np.sqrt((ratios[s] ** 2).sum())), 1e-12) for s in rows]
    alpha, weights, intercept = np.zeros(len(rows)), np.zeros(SLOTS), 0.0
    diagonal = 1 / (2 * cost)
    turn = np.random.default_rng(11)
    for _ in range(ROUNDS):
        for i in turn.permutation(len(rows)):
            slots, value = rows[i], values[i]
            gradient = sign[i] * (weights[slots] @ value + intercept) - 1 + diagonal[i] * alpha[i]
            step = max(alpha[i] - gradient / (2.0 + diagonal[i]), 0.0) - alpha[i]
            if step:
                alpha[i] += step
                weights[slots] += step * sign[i] * value
                intercept += step * sign[i]
    return weights, intercept


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the sigmoid, by Newton's method on smoothed labels."""
    ones = labels.sum()
    goal = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (goal - p))
        at += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def fit_rows(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    plain = Model(np.zeros(SLOTS), np.ones(SLOTS), 0.0, 0.0, float(np.log((labels.sum() + 1) / ((labels == 0).sum() + 1))))
    aside = np.arange(len(rows)) % CALIBRATION == 0
    if min((labels[~aside] == 1).sum(), (labels[~aside] == 0).sum()) == 0:
        return plain
    kept = [rows[i] for i in np.flatnonzero(~aside)]
    ratios = log_count_ratios(kept, labels[~aside])
    weights, intercept = descend(kept, labels[~aside], ratios)
    model = Model(weights * ratios, ratios**2, intercept, 1.0, 0.0)
    if min((labels[aside] == 1).sum(), (labels[aside] == 0).sum()) == 0:
        return model
    scores = np.array([model.score(rows[i]) for i in np.flatnonzero(aside)])
    slope, shift = calibrate(np.log(scores / (1 - scores)), labels[aside])
    return model._replace(slope=slope, shift=shift) if slope > 0 else model


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [s.astype(np.uint32).tobytes() for block in blocks(batch.column("text")) for s in row_slots(block)]
        yield pa.record_batch([batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())], names=["doc_id", "label", "slots"])


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, labels = [], []
    for batch in batches:
        rows += [np.frombuffer(s.as_py(), np.uint32) for s in batch.column("slots")]
        labels += batch.column("label").to_pylist()
    model = fit_rows(rows, np.array(labels, np.int64))
    yield pa.record_batch(
        [[model.weights.astype("<f4").tobytes()], [model.squares.astype("<f4").tobytes()], [model.intercept], [model.slope], [model.shift]],
        names=["weights", "squares", "intercept", "slope", "shift"],
    )


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether a row is never learned from: crc32 of its id as text leaves no rest by 5."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def labelled_sample(labels: DataFrame, label: str = "quality", most: int = SAMPLE) -> DataFrame:
    """doc_id, label: at most ``most`` rows to learn from, those with the smallest hash of their id."""
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("highest"))
        .filter("label = highest")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("long").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE) -> Model:
    sample = F.broadcast(labelled_sample(labels, label, most))  # at most ``most`` rows of two numbers
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")
    featured = chosen.mapInArrow(_featured, "doc_id long, label long, slots binary")
    row = featured.repartition(1).sortWithinPartitions("doc_id", "slots").mapInArrow(_fitted, MODEL_SCHEMA).first()
    if row is None:  # Spark needs no task to tell that there is nothing to learn from
        return fit_rows([], np.zeros(0, np.int64))
    return Model(
        np.frombuffer(row["weights"], "<f4"), np.frombuffer(row["squares"], "<f4"), row["intercept"], row["slope"], row["shift"]
    )


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``docs`` with score and predicted; one map over the texts."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.score(s) for block in blocks(batch.column("text")) for s in row_slots(block)])
            yield pa.record_batch([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scored, "doc_id long, score double")
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that the model rejects; nothing is shuffled."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.score(s) for block in blocks(batch.column("text")) for s in row_slots(block)])
            yield batch.filter(pa.array(scores >= threshold, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
