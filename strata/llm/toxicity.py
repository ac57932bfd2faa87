"""Toxicity: logistic regression over hashed word n-grams and skip-grams, learnt by FTRL-proximal.

Features of a text are the distinct hashed words, word pairs and pairs with one word between.
Words are runs of letters and digits in lower case. Spark splits and hashes them; a worker gets
64-bit hashes and adds up weights with numpy, over whole texts.

Learning reads a bounded sample of labelled rows (``Settings.most_examples``) in a fixed order on
the driver. FTRL keeps a learning rate per coordinate, and its L1 term leaves most weights at
exactly zero, so what goes to the workers is a short list of (index, weight).

Null and empty texts have no features: their score is that of the intercept. With no labelled
rows to learn from every score is 0.5 (predicted 1). Each row is scored by its own text, also if ids
repeat; of rows that share a labelled id one text is learnt from (that of the smallest hash). Columns
other than the id and the text are carried along or not read, whatever their names; a column
named ``toxic_score`` is replaced by ``predict``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import text as X


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    # Chosen by the log loss of cross-validation within labels that the registered query may learn from.
    alpha: float = 5.0
    beta: float = 1.0
    l1: float = 12.0
    l2: float = 1.0
    epochs: int = 3
    positive_weight: float = 2.0  # toxic rows are few; a missed one costs this much more
    min_examples: int = 2  # a feature of fewer learning texts gets no weight
    most_examples: int = 12000


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-case words of a text, in order."""
    parts = F.split(F.lower(X.filled(text)), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def features(hashes: np.ndarray, doc: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, index) of each distinct feature; ``doc`` is the document of each word."""
    h = hashes.view(np.uint64)
    docs, keys = [doc], [_mix(h)]
    for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        same = doc[:-gap] == doc[gap:]
        docs.append(doc[gap:][same])
        keys.append(_mix(h[:-gap][same] * np.uint64(salt) + h[gap:][same]))
    index = np.concatenate(keys) & np.uint64((1 << bits) - 1)
    both = np.unique((np.concatenate(docs).astype(np.uint64) << np.uint64(bits)) | index)
    return (both >> np.uint64(bits)).astype(np.int64), (both & np.uint64((1 << bits) - 1)).astype(
        np.int64
    )


def ftrl(examples: list[np.ndarray], labels: np.ndarray, s: Settings) -> tuple[dict, float]:
    """Weights that are not zero, by index, and the intercept. Rare features leave ``examples``."""
    z, n = np.zeros(1 << s.bits), np.zeros(1 << s.bits)
    seen = np.zeros(1 << s.bits, np.int64)
    for index in examples:
        seen[index] += 1
    for place, index in enumerate(examples):
        examples[place] = index[seen[index] >= s.min_examples]
    bias_z = bias_n = 0.0

    def weight(z, n):
        shrunk = np.sign(z) * s.l1 - z
        return np.where(np.abs(z) <= s.l1, 0.0, shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))

    def intercept():
        return -bias_z / ((s.beta + np.sqrt(bias_n)) / s.alpha)

    for _ in range(s.epochs):
        for index, label in zip(examples, labels):
            zi, ni = z[index], n[index]
            w, b = weight(zi, ni), intercept()
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + b, -35, 35))) - label
            g *= s.positive_weight if label else 1.0
            z[index] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / s.alpha * w
            n[index] = ni + g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / s.alpha * b
            bias_n += g * g
    w = weight(z, n)
    used = np.flatnonzero(w)
    return dict(zip(used.tolist(), w[used].tolist())), float(intercept())


def _flat(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    sizes = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return rows.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(rows)), sizes)


def _slices(rows: pa.Array, words: int = 1 << 17):
    """Runs of rows of about ``words`` words, so that a batch of long texts stays small."""
    ends = np.cumsum(rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(rows):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + words, "right")))
        yield start, stop, rows.slice(start, stop - start)
        start = stop


def _distinct(text: Column, bits: int) -> Column:
    """The distinct features of a text."""

    @F.arrow_udf("array<int>")
    def indexes(rows: pa.Array) -> pa.Array:
        sizes, values = [np.zeros(1, np.int32)], [np.zeros(0, np.int32)]
        for _, _, part in _slices(rows):
            doc, index = features(*_flat(part), bits)
            sizes.append(np.bincount(doc, minlength=len(part)))
            values.append(index)
        offsets = np.cumsum(np.concatenate(sizes)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values).astype(np.int32)))

    return indexes(word_hashes(text))


def fit(docs: DataFrame, labels: DataFrame, fold: Column, s: Settings = Settings()):
    """Learn from labelled documents; ``fold`` says which rows of ``labels`` may be used."""
    sample = X.labelled_sample(labels, "toxic", fold, s.most_examples)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # One text per id, whatever the number of its rows; tasks reduce it to its distinct features.
    rows = rows.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    table = rows.select("doc_id", "label", _distinct(F.col("text"), s.bits).alias("index")).toArrow()
    own = table["label"].to_numpy()
    order = np.argsort(table["doc_id"].to_numpy(), kind="stable")
    # A fixed order that has nothing to do with the ids' own.
    order = order[np.random.default_rng(1).permutation(len(order))]
    examples: list[np.ndarray] = []
    for chunk in table["index"].chunks:
        flat, _ = _flat(chunk)
        cuts = np.cumsum(chunk.value_lengths().to_numpy(zero_copy_only=False))[:-1]
        examples += np.split(flat, cuts) if len(chunk) else []
    del table
    examples = [examples[i] for i in order]
    return ftrl(examples, own[order], s)


def score(text: Column, weights: dict, intercept: float, bits: int = Settings.bits) -> Column:
    """Probability of label 1."""
    index = np.fromiter(weights, np.int64, len(weights))
    value = np.fromiter(weights.values(), float, len(weights))

    @F.arrow_udf("double")
    def probability(rows: pa.Array) -> pa.Array:
        dense = np.zeros(1 << bits)
        dense[index] = value
        out = np.zeros(len(rows))
        for start, stop, part in _slices(rows):
            doc, feature = features(*_flat(part), bits)
            out[start:stop] = np.bincount(doc, dense[feature], stop - start)
        return pa.array(1.0 / (1.0 + np.exp(-np.clip(out + intercept, -35, 35))))

    # A filter on the score must not make Spark compute it twice.
    return probability.asNondeterministic()(word_hashes(text))


def predict(docs: DataFrame, labels: DataFrame, fold: Column, s: Settings = Settings()) -> DataFrame:
    """``docs`` with ``toxic_score``."""
    return docs.withColumn("toxic_score", score(F.col("text"), *fit(docs, labels, fold, s), s.bits))
