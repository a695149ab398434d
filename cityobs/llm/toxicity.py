"""Toxic passages: maximum-scoring segments of token log-odds, with extreme-value calibration.

Every token of a text gets the log-odds of toxic against other training texts under a Dirichlet
prior (half a count each, and more by the tokens' overall shares). Copies among the training texts count once. A token is a word, or the beginning of
a word too rare in the training texts to be judged whole. One pass over the scores finds all
disjoint maximum-scoring segments. How high the best segment of a clean text of n tokens gets by
chance follows an extreme-value distribution, whose two parameters are fitted on clean texts left
out of training; segments less likely than ``SIGNIFICANCE`` are reported and summed up, and a
logistic curve over the sum, fitted on texts left out, gives the probability.

Defined cases: a null text is an empty one; a text without words has no segment and the lowest
score; without both classes among the training texts every score is their share (0.5 without any);
of equal segments both are reported; repeated rows are scored alike; other columns pass untouched.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cityobs.llm.quality import _logistic, _logistic_fit

WORD = re.compile(r"\w+")
#: Occurrences in the training texts that a word, or a beginning, needs to be judged itself.
MIN_COUNT = 8
#: Lengths of the beginnings that stand for rarer words, longest first.
BEGINNINGS = (7, 6, 5, 4)
#: Standard deviations from zero at which log-odds count nothing.
DOUBT = 2.0
#: The Dirichlet prior's count of each unit, and what the units share out by their frequency besides.
LEAST_PRIOR, PRIOR = 0.5, 500.0
#: Smallest word hashes that near copies among the training texts have in common.
COPY_HASHES = 6
#: Chance of the best segment of a clean text at which a segment is reported.
SIGNIFICANCE = 0.05
#: Words whose scores a Python worker remembers.
REMEMBERED = 200_000


def units(word: str) -> list[str]:
    """The word and its beginnings, longest first. Beginnings carry a mark that no word has."""
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) >= n)]


@dataclass
class Model:
    odds: dict[str, float]
    other: float = 0.0
    decay: float = 1.0
    level: float = 0.0
    slope: float = 1.0
    offset: float = 0.0
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def weight(self, word: str) -> float:
        found = next((self.odds[u] for u in units(word) if u in self.odds), self.other)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self.known[word] = found
        return found

    def weights(self, words: list[str]) -> np.ndarray:
        known, weight = self.known, self.weight
        return np.array([known[w] if w in known else weight(w) for w in words], float)

    def normalised(self, total: float, n: int) -> float:
        """How far beyond chance a segment's total is in a text of n tokens, in natural logarithms."""
        return self.decay * total - self.level - math.log(max(n, 1))

    def passages(self, text: str) -> list[tuple[int, int, float]]:
        """Start and end (code points) and normalised total of every significant segment."""
        found = list(WORD.finditer(text.lower())) if len(text.lower()) == len(text) else list(WORD.finditer(text))
        weights = self.weights([m[0].lower() for m in found])
        least = -math.log(-math.log1p(-SIGNIFICANCE))
        out = []
        for first, last, total in segments(weights):
            value = self.normalised(total, len(found))
            if value >= least:
                out.append((found[first].start(), found[last - 1].end(), value))
        return out

    def evidence(self, text: str) -> float:
        """Sum over the significant segments, or the best one's value, on a logarithmic scale."""
        weights = self.weights(WORD.findall(text.lower()))
        totals = [total for _, _, total in segments(weights)]
        if not totals:
            return -math.log1p(10.0)
        values = [self.normalised(t, len(weights)) for t in totals]
        least = -math.log(-math.log1p(-SIGNIFICANCE))
        beyond = sum(v for v in values if v >= least)
        value = beyond or max(values)
        return math.copysign(math.log1p(abs(value)), value)

    def score(self, text: str) -> float:
        return _logistic(self.slope * self.evidence(text) + self.offset)


def segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximum-scoring segments as (first, past the last, total), in order, in linear time.

    Runs of tokens of one sign are taken as one; among them, each positive run joins the nearest
    earlier segment whose prefix sum is lower, as long as that one ends lower than it does.
    """
    if not (weights > 0).any():
        return []
    sums = np.concatenate([[0.0], np.cumsum(weights)])
    positive = np.concatenate([[False], weights > 0, [False]])
    firsts = np.flatnonzero(positive[1:] & ~positive[:-1])
    lasts = np.flatnonzero(positive[:-1] & ~positive[1:])
    open_: list[tuple[int, int, float, float, int]] = []  # first, last, left sum, right sum, nearest lower
    for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True):
        left, right = float(sums[a]), float(sums[b])
        while True:
            j = len(open_) - 1
            while j >= 0 and open_[j][2] >= left:
                j = open_[j][4]
            if j < 0 or open_[j][3] >= right:
                break
            a, left = open_[j][0], open_[j][2]
            del open_[j:]
        open_.append((a, b, left, right, j))
    return [(a, b, right - left) for a, b, left, right, _ in open_]


def log_odds(texts: list[set[str]], labels: np.ndarray) -> tuple[dict[str, float], float]:
    """Log-odds of every unit that can be judged, and of all others together.

    A text counts each unit once, so that one text's repetitions are no evidence.
    """
    words = Counter(w for text in texts for w in text)
    counts = Counter()
    for w, n in words.items():
        for u in units(w):
            counts[u] += n
    unit = {w: next((u for u in units(w) if counts[u] >= MIN_COUNT), "") for w in words}
    by = [Counter(), Counter()]
    for text, y in zip(texts, labels, strict=True):
        by[int(y)].update({unit[w] for w in text})
    total = by[0] + by[1]
    size, n0, n1 = sum(total.values()), sum(by[0].values()), sum(by[1].values())
    odds = {}
    for u, n in total.items():
        a = LEAST_PRIOR + PRIOR * n / size
        p1, p0 = by[1][u] + a, by[0][u] + a
        value = math.log(p1 / (n1 + PRIOR - p1)) - math.log(p0 / (n0 + PRIOR - p0))
        z = value / math.sqrt(1 / p1 + 1 / p0)
        odds[u] = value * max(0.0, 1 - (DOUBT / z) ** 2) if z else 0.0  # what chance may give counts less
    other = odds.pop("", 0.0)
    return odds, other


def _drift(odds: dict[str, float], other: float, texts: list[list[str]]) -> tuple[dict[str, float], float]:
    """Scores less a constant, so that a clean text's sum falls in the mean."""
    model = Model(odds, other)
    sums = [(model.weights(t).sum(), len(t)) for t in texts if t]
    mean = sum(s for s, _ in sums) / max(1, sum(n for _, n in sums))
    shift = max(0.0, mean) + 0.02
    return {u: float(v - shift) for u, v in odds.items()}, other - shift


#: Where the median and the upper tenth of Gumbel's law lie.
_GUMBEL = tuple(-math.log(-math.log(p)) for p in (0.5, 0.9))


def _without_copies(samples: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """The first text of each group of copies and near copies of one label: a copied text is one
    piece of evidence, and one that lies in several folds would make them tell of each other."""
    seen, out = set(), []
    for text, y in samples:
        words = {zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in WORD.findall(text.lower())}
        key = y, tuple(sorted(words)[:COPY_HASHES])
        if key not in seen:
            seen.add(key)
            out.append((text, y))
    return out


def fit(samples: list[tuple[str, int]], folds: int = 3) -> Model:
    labels = np.array([y for _, y in samples], int)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        return Model({}, 0.0, slope=0.0, offset=math.log(share / (1 - share)))
    samples = _without_copies(samples)
    labels = np.array([y for _, y in samples], int)
    texts = [WORD.findall(text.lower()) for text, _ in samples]

    def part(which: np.ndarray) -> Model:
        some, ys = [texts[i] for i in which], labels[which]
        odds, other = log_odds([set(t) for t in some], ys)
        clean = [t for t, y in zip(some, ys, strict=True) if y == 0]
        return Model(*_drift(odds, other, clean))

    def best(model: Model, text: list[str]) -> float:
        return max((t for _, _, t in segments(model.weights(text))), default=0.0)

    models, left = [], []
    for k in range(folds):
        out = np.arange(len(texts)) % folds == k
        if len(set(labels[~out].tolist())) == 2:
            models.append(part(np.flatnonzero(~out)))
            left.append(np.flatnonzero(out))
    whole = part(np.arange(len(texts)))
    if not models:
        return whole
    clean = [(best(m, texts[i]), len(texts[i])) for m, out in zip(models, left, strict=True) for i in out if labels[i] == 0 and texts[i]]
    whole.decay, whole.level = _extreme_value([s for s, _ in clean], [n for _, n in clean])
    xs, ys = [], []
    for m, out in zip(models, left, strict=True):
        m.decay, m.level = whole.decay, whole.level
        xs += [m.evidence(samples[i][0]) for i in out]
        ys += labels[out].tolist()
    if len(set(ys)) == 2:
        whole.slope, whole.offset = _logistic_fit(np.array(xs), np.array(ys))
    return whole


def _extreme_value(best: list[float], lengths: list[int]) -> tuple[float, float]:
    """Decay and level of P(best > s) = 1 - exp(-n exp(level - decay s)), by two quantiles.

    With y = s - log(n) / decay the law is Gumbel's with scale 1 / decay; its median and its upper
    tenth give both parameters, whatever a few texts far out are like.
    """
    s, log_n = np.array(best), np.log(np.maximum(lengths, 1))
    if len(s) < 5 or s.std() < 1e-6:
        return 1.0, 0.0
    decay = 1.0
    for _ in range(100):
        middle, upper = np.quantile(s - log_n / decay, [0.5, 0.9])
        new = min(max((_GUMBEL[1] - _GUMBEL[0]) / max(upper - middle, 1e-3), 0.2), 5.0)
        if abs(new - decay) < 1e-6:
            break
        decay = 0.5 * (decay + new)
    mode = np.quantile(s - log_n / decay, 0.5) - _GUMBEL[0] / decay
    return float(decay), float(decay * mode)


def score(df: DataFrame, model: Model, text: str = "text", into: str = "score", drop_text: bool = False, spans: bool = False) -> DataFrame:
    """All columns of ``df`` (without the text if asked) plus the probability of a toxic text.

    ``spans`` adds ``passages``: start, end (code points) and strength of each significant segment.
    """
    kept = [f for f in df.schema if not (drop_text and f.name == text)]
    schema = T.StructType([*kept, T.StructField(into, T.DoubleType(), False)])
    passage = T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType()).add("strength", T.DoubleType())
    if spans:
        schema.add("passages", T.ArrayType(passage))
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("strength", pa.float64())]))
    at = df.columns.index(text)
    columns = [df.columns.index(f.name) for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            out = [*(batch.column(i) for i in columns), pa.array([model.score(t) for t in texts], pa.float64())]
            if spans:
                found = [[dict(zip(("start", "end", "strength"), p, strict=True)) for p in model.passages(t)] for t in texts]
                out.append(pa.array(found, arrow))
            yield pa.RecordBatch.from_arrays(out, names=schema.fieldNames())

    return df.mapInArrow(run, schema)
