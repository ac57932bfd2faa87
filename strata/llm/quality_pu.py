"""Quality classifier learnt from positive and unlabelled texts.

The risk of a linear scorer g under the squared loss is estimated without any negative example:
``prior * E_p[loss(g, 1)]`` plus the part of the negatives, ``E_u[loss(g, 0)] - prior *
E_p[loss(g, 0)]``. That part cannot be below zero in truth, so when its estimate is, the step
goes up its slope instead of down the whole risk (the non-negative estimator).

With this loss the risk depends on the data only through first and second moments of the
features. So all unlabelled texts take part: Spark adds up their moments in one pass, the driver
gets a matrix of fixed size, and the minimisation needs no further pass over the data.

Features describe a whole text and are plain numbers of fixed count: shares of byte values and of
hashed byte pairs (square roots), and how much words and lines repeat. Trusted positives are a
bounded sample of the training rows labelled 1 (``Settings.most_positives``); the class prior is
the share of label 1 among all training labels. Unlabelled texts are the texts of the training
fold, whatever their label.

Defined cases: null and empty texts have only the constant feature. With no positives or no texts
to learn from every score is 0.5. Repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import text as X

_BYTES, _PAIRS, _SHAPES = 144, 48, 6
SIZE = 1 + _BYTES + _PAIRS + _SHAPES
# Bytes below 128 have a bin each, those above share one with seven neighbours.
_BIN = np.concatenate([np.arange(128), 128 + np.arange(128) // 8]).astype(np.int64)


@dataclass(frozen=True)
class Settings:
    most_positives: int = 50_000
    ridge: float = 1e-3
    steps: int = 300
    rate: float = 0.5


def measured(text: Column) -> Column:
    """What a worker needs of a text: its bytes and the counts behind the shape features.

    No lambda in here: a Python function over nested lambdas is not always found by Spark's rule
    that moves such functions to the Python worker, and the query then fails.
    """
    words, lines = X.words(text), F.split(X.filled(text), "\n")
    return F.struct(
        X.filled(text).cast("binary").alias("bytes"),
        F.size(words).alias("words"),
        F.size(F.array_distinct(words)).alias("distinct_words"),
        F.size(lines).alias("lines"),
        F.size(F.array_distinct(lines)).alias("distinct_lines"),
    )


def _columns(rows: pa.StructArray) -> tuple[pa.Array, np.ndarray]:
    names = ("words", "distinct_words", "lines", "distinct_lines")
    counts = [rows.field(name).to_numpy(zero_copy_only=False) for name in names]
    return rows.field("bytes"), np.stack(counts).astype(float)


def _histograms(data: pa.Array, most: int = 1 << 22) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte bins and byte-pair bins per text, and sizes; a few million bytes at a time."""
    n = len(data)
    offsets = np.frombuffer(data.buffers()[1], np.int32, n + 1, data.offset * 4).astype(np.int64)
    raw = np.frombuffer(data.buffers()[2] or b"", np.uint8)
    singles, pairs = np.zeros(n * _BYTES), np.zeros(n * _PAIRS)
    for start in range(int(offsets[0]), int(offsets[-1]), most):
        stop = min(start + most, int(offsets[-1]))
        block = raw[start:stop]
        row = np.searchsorted(offsets, np.arange(start, stop, 1 << 8), "right") - 1
        low, high = int(row[0]), int(np.searchsorted(offsets, stop, "left"))
        inside = np.clip(offsets[low : high + 1], start, stop)
        owner = np.repeat(np.arange(high - low), np.diff(inside))
        singles[low * _BYTES : high * _BYTES] += np.bincount(
            owner * _BYTES + _BIN[block], minlength=(high - low) * _BYTES
        )
        hashed = (block[:-1].astype(np.uint32) * 2654435 + block[1:].astype(np.uint32) * 40503) >> 7
        same = owner[:-1] == owner[1:]
        pairs[low * _PAIRS : high * _PAIRS] += np.bincount(
            (owner[:-1] * _PAIRS + hashed % _PAIRS)[same], minlength=(high - low) * _PAIRS
        )
    return singles.reshape(n, _BYTES), pairs.reshape(n, _PAIRS), np.diff(offsets)


def features(rows: pa.StructArray) -> np.ndarray:
    """One row of ``SIZE`` numbers per text."""
    data, (words, distinct, lines, distinct_lines) = _columns(rows)
    singles, pairs, size = _histograms(data)
    some = np.maximum(size, 1)[:, None]
    many = np.maximum(words, 1)
    shapes = np.stack(
        [
            distinct / many,
            np.log1p(words) / 10,
            np.minimum(size / many, 50) / 10,
            distinct_lines / np.maximum(lines, 1),
            lines / many,
            np.log1p(words) / 10 * distinct / many,
        ],
        axis=1,
    )
    shapes[size == 0] = 0
    one = np.ones((len(size), 1))
    return np.hstack([one, np.sqrt(singles / some), np.sqrt(pairs / some), shapes])


_UPPER = np.triu_indices(SIZE)


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Second moments (first ones are in their first row) of unlabelled and positive texts."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, groups = np.zeros((2, SIZE, SIZE)), ("unlabelled", "positive")
        for batch in batches:
            phi = features(batch.column("measured"))
            for k, name in enumerate(groups):
                chosen = phi[batch.column(name).to_numpy(zero_copy_only=False)]
                total[k] += chosen.T @ chosen
        cells = np.arange(len(_UPPER[0]), dtype=np.int32)
        sums = [pa.array(total[k][_UPPER]) for k in range(2)]
        yield pa.RecordBatch.from_arrays([pa.array(cells), *sums], ["cell", "u", "p"])

    parts = rows.mapInArrow(add_up, "cell int, u double, p double")
    added = parts.groupBy("cell").agg(F.sum("u").alias("u"), F.sum("p").alias("p"))
    table = added.toArrow().sort_by("cell")
    full = []
    for name in ("u", "p"):
        matrix = np.zeros((SIZE, SIZE))
        if table.num_rows:
            matrix[_UPPER] = table[name].to_numpy()
        full.append(matrix + np.triu(matrix, 1).T)
    return full[0], full[1]


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    # Elementwise: the threads of a matrix library may not survive the fork that starts Spark.
    return (matrix * vector).sum(axis=1)


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan elimination of a positive definite matrix, elementwise for the same reason."""
    left, right = matrix.copy(), np.eye(len(matrix))
    for i in range(len(matrix)):
        right[i] /= left[i, i]
        left[i] /= left[i, i]
        factor = left[:, i].copy()
        factor[i] = 0
        left -= factor[:, None] * left[i]
        right -= factor[:, None] * right[i]
    return right


def minimise(u: np.ndarray, p: np.ndarray, prior: float, s: Settings) -> np.ndarray:
    """Weights of the scorer from the moments; all zero if there is nothing to learn from.

    The losses are (1 - g)^2 / 4 for label 1 and (1 + g)^2 / 4 for label 0, so means of losses
    and their slopes are quadratic and linear in the weights.
    """
    if not u[0, 0] or not p[0, 0]:
        return np.zeros(SIZE)
    u, p = u / u[0, 0], p / p[0, 0]

    def loss(m, w, sign):
        return (1 - 2 * sign * (m[0] * w).sum() + (w * _times(m, w)).sum()) / 4

    def slope(m, w, sign):
        return (_times(m, w) - sign * m[0]) / 2

    def descend(scale, rate):
        w = np.zeros(SIZE)
        for _ in range(s.steps):
            negative = loss(u, w, -1) - prior * loss(p, w, -1)
            down = slope(u, w, -1) - prior * slope(p, w, -1)
            if negative < 0:
                step = -down
            else:
                step = prior * slope(p, w, 1) + down
            w -= rate * _times(scale, step + s.ridge * w / 2)
        return w

    def risk(w):
        return prior * loss(p, w, 1) + max(loss(u, w, -1) - prior * loss(p, w, -1), 0.0)

    # A fixed change of scale lets one step length fit all directions. A few positives that lie far
    # out make the loss steeper than the unlabelled texts tell, and the steps grow without end; then
    # the scale takes them in too, and the steps get shorter until the risk is below that of no weights.
    most, rate, spread = risk(np.zeros(SIZE)), s.rate, u
    for _ in range(8):
        with np.errstate(over="ignore", invalid="ignore"):
            w = descend(_inverse(spread + s.ridge * np.eye(SIZE)), rate)
            if np.isfinite(w).all() and risk(w) <= most:
                return w
        rate, spread = rate / 2, u + p
    return np.zeros(SIZE)


def fit(docs: DataFrame, labels: DataFrame, fold: Column, s: Settings = Settings()) -> np.ndarray:
    """``fold`` says which ids (column doc_id) may be learnt from."""
    known = labels.where(fold & F.col("quality").isNotNull())
    prior = known.agg(F.avg("quality")).first()[0]
    if prior is None:
        return np.zeros(SIZE)
    sample = X.labelled_sample(labels, "quality", fold, s.most_positives, only=1).select(
        F.col("doc_id").alias("trusted")
    )
    rows = docs.select("doc_id", "text").where(fold)
    rows = rows.join(F.broadcast(sample), F.col("doc_id") == F.col("trusted"), "left").select(
        measured(F.col("text")).alias("measured"),
        F.lit(True).alias("unlabelled"),
        F.col("trusted").isNotNull().alias("positive"),
    )
    return minimise(*_moments(rows), prior, s)


def score(text: Column, weights: np.ndarray) -> Column:
    """Between 0 and 1; the squared loss makes (1 + g) / 2 the probability of label 1."""

    @F.arrow_udf("double")
    def quality_share(rows: pa.Array) -> pa.Array:
        return pa.array(np.clip((1 + _times(features(rows), weights)) / 2, 0.0, 1.0))

    # A filter on the score must not make Spark compute it twice.
    return quality_share.asNondeterministic()(measured(text))
