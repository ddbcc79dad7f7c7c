"""Quality classifier: a factorisation machine.

Features of a document: its hashed words (log term frequency, normalised
to length 1), structure statistics and metadata, each cut into bins.  The
score adds a low-rank interaction of every pair of features; by the
sum-of-squares identity that is ((sum of v x)^2 - sum of (v x)^2) / 2 per
factor, so a document is scored in time linear in its features.

Fitted with Adagrad in one task from a bounded labelled sample
(``PER_CLASS`` documents of each label); scoring is one narrow pass over
the texts with the model (about 2 MB, fixed by ``BUCKETS``) broadcast.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import map_texts, spaced, split_distinct
from tidemark.llm.labelled import fit_in_task, fitting_sample

BUCKETS = 1 << 16
FACTORS = 8
PER_CLASS = 2000
BINS = 16
#: Statistic and the bounds of its bins.
STATISTICS = {
    "characters": np.geomspace(16, 2 ** 18, BINS - 1),
    "words": np.geomspace(4, 2 ** 16, BINS - 1),
    "lines": np.geomspace(1.5, 2 ** 12, BINS - 1),
    "characters_of_a_word": np.linspace(2, 10, BINS - 1),
    "distinct_words": np.linspace(0.05, 0.95, BINS - 1),
    "upper_case": np.geomspace(0.004, 0.7, BINS - 1),
    "digits": np.geomspace(0.002, 0.5, BINS - 1),
    "marks": np.geomspace(0.004, 0.5, BINS - 1),
    "rare_marks": np.geomspace(0.002, 0.4, BINS - 1),
    "not_ascii": np.geomspace(0.002, 0.7, BINS - 1),
    "white_space": np.linspace(0.05, 0.4, BINS - 1),
}
#: Weight of a statistic's bin beside the words' unit length.
STATISTIC_VALUE = 0.4
DIMENSIONS = BUCKETS + len(STATISTICS) * BINS

_UPPER, _DIGIT, _MARK, _RARE, _HIGH, _WHITE, _LINE, _LEAD = (1 << i for i in range(8))
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91] = _UPPER
_CLASS[48:58] = _DIGIT
_CLASS[[b for b in range(33, 127) if not chr(b).isalnum()]] = _MARK
for _b in b"#$%&*+/<=>@\\^_`{|}~[]":
    _CLASS[_b] |= _RARE
_CLASS[128:] = _HIGH
_CLASS[[9, 10, 11, 12, 13, 32]] = _WHITE
_CLASS[10] |= _LINE
_CLASS[[b for b in range(256) if b & 0xC0 != 0x80]] |= _LEAD


class Features(NamedTuple):
    """Sparse rows: row i holds ``index`` and ``value`` from ``starts[i]``
    up to ``starts[i + 1]``."""
    index: np.ndarray
    value: np.ndarray
    starts: np.ndarray


def _class_counts(texts: pa.Array) -> dict[int, np.ndarray]:
    """Characters of each class in each text, from the UTF-8 bytes."""
    lens = pa.compute.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(lens)])
    data = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), np.uint8)
    kinds = _CLASS[data]
    out = {}
    for bit in (_UPPER, _DIGIT, _MARK, _RARE, _HIGH, _WHITE, _LINE, _LEAD):
        run = np.concatenate([[0], np.cumsum((kinds & bit) != 0)])
        out[bit] = (run[ends[1:]] - run[ends[:-1]]).astype(np.float64)
    return out


def features(texts: pa.Array) -> Features:
    """Features of texts (no nulls)."""
    n = len(texts)
    words, place, cuts = split_distinct(spaced(texts))
    bucket = np.fromiter((zlib.crc32(w.encode()) % BUCKETS if w else -1 for w in words),
                         np.int64, len(words))[place]
    doc = np.repeat(np.arange(n), np.diff(cuts))
    real = bucket >= 0
    doc, bucket, place = doc[real], bucket[real], place[real]
    n_words = np.bincount(doc, minlength=n).astype(np.float64)
    pairs, tf = np.unique(doc * BUCKETS + bucket, return_counts=True)
    row, word = pairs // BUCKETS, pairs % BUCKETS
    x = np.log1p(tf)
    norm = np.sqrt(np.bincount(row, x * x, minlength=n))
    x = x / norm[row]

    c = _class_counts(texts)
    chars = np.maximum(c[_LEAD], 1.0)
    at_least = np.maximum(n_words, 1.0)
    stats = [c[_LEAD], n_words, c[_LINE] + 1, (chars - c[_WHITE]) / at_least,
             np.bincount(row, minlength=n) / at_least, c[_UPPER] / chars, c[_DIGIT] / chars,
             c[_MARK] / chars, c[_RARE] / chars, (c[_HIGH] / 2) / chars, c[_WHITE] / chars]
    extra = np.stack([BUCKETS + i * BINS + np.searchsorted(bounds, v)
                      for i, (bounds, v) in enumerate(zip(STATISTICS.values(), stats))], axis=1)

    row = np.concatenate([row, np.repeat(np.arange(n), extra.shape[1])])
    order = np.argsort(row, kind="stable")
    index = np.concatenate([word, extra.ravel()])[order]
    value = np.concatenate([x, np.full(extra.size, STATISTIC_VALUE)])[order]
    starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
    return Features(index, value, starts)


class FactorisationMachine(NamedTuple):
    bias: float
    linear: np.ndarray   # (DIMENSIONS,)
    factors: np.ndarray  # (DIMENSIONS, FACTORS)

    def margin(self, f: Features) -> np.ndarray:
        at = f.starts[:-1]
        vx = self.factors[f.index] * f.value[:, None]
        total, squares = np.add.reduceat(vx, at), np.add.reduceat(vx * vx, at)
        return (self.bias + np.add.reduceat(self.linear[f.index] * f.value, at)
                + 0.5 * (total * total - squares).sum(axis=1))

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of label 1 for texts (no nulls)."""
        return 1 / (1 + np.exp(-np.clip(self.margin(features(texts)), -40, 40)))


def _rows(f: Features, which: np.ndarray) -> Features:
    lens = f.starts[which + 1] - f.starts[which]
    ends = np.cumsum(lens)
    at = np.arange(ends[-1]) + np.repeat(f.starts[which] - (ends - lens), lens)
    return Features(f.index[at], f.value[at], np.concatenate([[0], ends]))


def _all_features(texts: pa.Array, step: int = 200) -> Features:
    """Features of many texts, some at a time."""
    parts = [features(texts.slice(i, step)) for i in range(0, len(texts), step)]
    lens = np.concatenate([np.diff(p.starts) for p in parts])
    return Features(np.concatenate([p.index.astype(np.int32) for p in parts]),
                    np.concatenate([p.value.astype(np.float32) for p in parts]),
                    np.concatenate([[0], np.cumsum(lens)]))


def fit(texts: pa.Array, labels: np.ndarray, *, epochs: int = 6, batch: int = 64,
        rate: float = 0.1, decay: float = 1e-4, seed: int = 7) -> FactorisationMachine:
    """Adagrad on the logistic loss.  Without both labels the model is the
    constant share of label 1 (one half without any)."""
    rng = np.random.default_rng(seed)
    linear = np.zeros(DIMENSIONS)
    factors = rng.normal(0, 0.01, (DIMENSIONS, FACTORS))
    if len(labels) == 0 or labels.min() == labels.max():
        p = 0.5 if len(labels) == 0 else 0.999 if labels[0] else 0.001
        return FactorisationMachine(float(np.log(p / (1 - p))), linear, factors * 0)
    f = _all_features(texts)
    bias, seen_b = 0.0, 1e-8
    seen_l, seen_f = np.full(DIMENSIONS, 1e-8), np.full((DIMENSIONS, FACTORS), 1e-8)
    # both labels weigh the same in the fit's order, not in its loss
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            which = order[at:at + batch]
            b = _rows(f, which)
            row = np.repeat(np.arange(len(which)), np.diff(b.starts))
            model = FactorisationMachine(bias, linear, factors)
            error = 1 / (1 + np.exp(-np.clip(model.margin(b), -40, 40))) - labels[which]
            v = factors[b.index]
            total = np.add.reduceat(v * b.value[:, None], b.starts[:-1])
            e, x = error[row], b.value
            g_lin = e * x
            g_fac = (e * x)[:, None] * (total[row] - v * x[:, None])
            used, back = np.unique(b.index, return_inverse=True)
            g_lin = np.bincount(back, g_lin) / len(which) + decay * linear[used]
            sums = np.zeros((len(used), FACTORS))
            for k in range(FACTORS):
                sums[:, k] = np.bincount(back, g_fac[:, k])
            g_fac = sums / len(which) + decay * factors[used]
            seen_l[used] += g_lin * g_lin
            linear[used] -= rate * g_lin / np.sqrt(seen_l[used])
            seen_f[used] += g_fac * g_fac
            factors[used] -= 0.2 * rate * g_fac / np.sqrt(seen_f[used])
            g_b = error.mean()
            seen_b += g_b * g_b
            bias -= rate * g_b / np.sqrt(seen_b)
    return FactorisationMachine(float(bias), linear.astype(np.float32),
                                factors.astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality",
          per_class: int = PER_CLASS) -> FactorisationMachine:
    """Fit on at most ``per_class`` labelled documents of each label, held-out
    rows excluded; empty labels give the constant model one half."""
    return fit_in_task(fitting_sample(docs, labels, label, per_class=per_class), fit)


def score_quality(docs: DataFrame, model: FactorisationMachine, *, text: str = "text",
                  carry: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the ``carry`` columns, all by default) and
    ``score`` (0 to 1, higher: label 1 likelier).

    Null and empty texts score by their statistics alone; repeated rows
    score alike; no rows give no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def make():
        own = FactorisationMachine(*shared.value)
        return lambda texts: [pa.array(own.score(texts), pa.float64())]

    return map_texts(docs, text, docs.columns if carry is None else carry, "score double", make,
                     max_bytes=1 << 20)
