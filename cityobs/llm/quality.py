"""Quality scores: naive Bayes log-count ratios as feature weights of a linear support vector machine.

Indicators of byte n-grams (hashed into a fixed number of slots) and of bigrams of one word (how
often a word follows itself) are scaled by the log ratio of their class counts and divided by their
length, to which a constant is added so that few n-grams decide little; dual coordinate descent fits a hinge-loss model;
margins become probabilities by a logistic curve fitted on margins of texts left out.

Defined cases: a null text is an empty one; an empty text has no features and gets the score of the
intercept; without both classes among the training texts every score is their share (0.5 without
any); repeated rows are scored alike; other columns pass through untouched whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Slots of each n-gram length, as a power of two.
BITS = 16
#: Lengths of the byte n-grams.
LENGTHS = (1, 2, 3)
#: Word repetitions are counted in powers of two up to this many.
REPEATS = 8
GRAMS = len(LENGTHS) << BITS
SLOTS = GRAMS + REPEATS
#: Squared length that every text has besides that of its n-grams.
FLOOR = 60.0
#: Bytes that are turned into n-grams at once, so that a long text needs no more memory.
STEP = 1 << 18


def features(text: str) -> np.ndarray:
    """Slots of the n-grams that occur in the whole text, ascending, and the intercept's slot."""
    seen = np.zeros(SLOTS + 1, bool)
    seen[SLOTS] = True
    codes = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    for start in range(0, len(codes), STEP):
        part = codes[start : start + STEP + max(LENGTHS) - 1].astype(np.uint32)
        value = np.zeros(len(part), np.uint32)
        for k, n in enumerate(LENGTHS):
            if len(part) < n:
                break
            value = (value[: len(part) - n + 1] << 8 | part[n - 1 :]) if n > 1 else part
            slots = value if 8 * n <= BITS else (value * np.uint32(2654435761)) >> np.uint32(32 - BITS)
            seen[(k << BITS) + slots] = True
    words = text.split()
    repeated = sum(map(eq, words, words[1:]))
    seen[GRAMS : GRAMS + min(REPEATS, repeated.bit_length())] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    """Log-count ratios, the plane's weights, and the logistic curve over its margins."""

    ratio: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float

    def margin(self, slots: np.ndarray) -> float:
        return float(_scaled(self.ratio, slots) @ self.weights[slots])

    def score(self, text: str) -> float:
        return _logistic(self.slope * self.margin(features(text)) + self.offset)


def _scaled(ratio: np.ndarray, slots: np.ndarray) -> np.ndarray:
    values = ratio[slots]
    return values / math.sqrt(float(np.square(values).sum()) + FLOOR)


def _logistic(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    counts = np.full((2, SLOTS + 1), smoothing)
    for slots, y in zip(rows, labels, strict=True):
        counts[int(y), slots] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ratio[SLOTS] = 1.0  # the intercept
    return ratio


def coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, penalty: np.ndarray, epochs: int = 12, seed: int = 7
) -> np.ndarray:
    """Weights of the L1 hinge loss by dual coordinate descent; ``penalty`` bounds each dual variable."""
    weights, dual = np.zeros(SLOTS + 1), np.zeros(len(rows))
    norms = np.array([max(float(np.square(v).sum()), 1e-12) for v in values])
    order, random = np.arange(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        random.shuffle(order)
        moved = 0.0
        for i in order:
            gradient = signs[i] * float(weights[rows[i]] @ values[i]) - 1
            new = min(max(dual[i] - gradient / norms[i], 0.0), penalty[i])
            if new != dual[i]:
                weights[rows[i]] += (new - dual[i]) * signs[i] * values[i]
                moved = max(moved, abs(new - dual[i]))
                dual[i] = new
        if moved < 1e-3:
            break
    return weights


def _plane(rows: list[np.ndarray], labels: np.ndarray, cost: float) -> tuple[np.ndarray, np.ndarray]:
    ratio = log_count_ratio(rows, labels)
    values = [_scaled(ratio, slots) for slots in rows]
    return ratio, coordinate_descent(rows, values, 2.0 * labels - 1, np.full(len(rows), cost))


def _logistic_fit(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method, with the usual softened targets."""
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    point = np.array([1.0, 0.0])
    x = np.stack([margins, np.ones_like(margins)], 1)

    def loss(p):
        z = x @ p
        return float((np.logaddexp(0, z) - target * z).sum())

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ point, -40, 40)))
        gradient = x.T @ (p - target)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-6 and loss(point - size * step) > loss(point):
            size /= 2
        point = point - size * step
        if float(np.abs(size * step).max()) < 1e-8:
            break
    return float(point[0]), float(point[1])


def fit(samples: list[tuple[str, int]], cost: float = 1.0, folds: int = 3) -> Model:
    labels = np.array([y for _, y in samples], int)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        return Model(np.ones(SLOTS + 1), np.zeros(SLOTS + 1), 1.0, math.log(share / (1 - share)))
    rows = [features(text) for text, _ in samples]
    ratio, weights = _plane(rows, labels, cost)
    margins, left = np.zeros(len(rows)), np.zeros(len(rows), bool)
    for k in range(folds):
        out = np.arange(len(rows)) % folds == k
        if len(set(labels[~out].tolist())) < 2:
            continue
        inside = [rows[i] for i in np.flatnonzero(~out)]
        part = Model(*_plane(inside, labels[~out], cost), 1.0, 0.0)
        margins[out] = [part.margin(rows[i]) for i in np.flatnonzero(out)]
        left |= out
    if len(set(labels[left].tolist())) < 2:
        return Model(ratio, weights, 4.0, 0.0)
    return Model(ratio, weights, *_logistic_fit(margins[left], labels[left]))


def score(df: DataFrame, model: Model, text: str = "text", into: str = "score", drop_text: bool = False) -> DataFrame:
    """All columns of ``df`` (without the text if asked) plus the probability of label 1."""
    kept = [f for f in df.schema if not (drop_text and f.name == text)]
    schema = T.StructType([*kept, T.StructField(into, T.DoubleType(), False)])
    at = df.columns.index(text)
    columns = [df.columns.index(f.name) for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t or "") for t in batch.column(at).to_pylist()]
            out = [*(batch.column(i) for i in columns), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(out, names=schema.fieldNames())

    return df.mapInArrow(run, schema)
