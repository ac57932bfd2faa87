"""FTRL-proximal against a plain loop, and the operator on awkward rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import toxicity as T


def plain_ftrl(examples, labels, s):
    """One coordinate at a time, in the textbook form."""
    seen = {}
    for index in examples:
        for i in index:
            seen[i] = seen.get(i, 0) + 1
    z, n, bz, bn = {}, {}, 0.0, 0.0

    def weight(i):
        if abs(z.get(i, 0.0)) <= s.l1:
            return 0.0
        return (math.copysign(s.l1, z[i]) - z[i]) / ((s.beta + math.sqrt(n[i])) / s.alpha + s.l2)

    def bias():
        return -bz / ((s.beta + math.sqrt(bn)) / s.alpha)

    for _ in range(s.epochs):
        for index, label in zip(examples, labels):
            index = [i for i in index if seen[i] >= s.min_examples]
            w, b = {i: weight(i) for i in index}, bias()
            g = 1 / (1 + math.exp(-(sum(w.values()) + b))) - label
            g *= s.positive_weight if label else 1.0
            for i in index:
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / s.alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
            bz += g - (math.sqrt(bn + g * g) - math.sqrt(bn)) / s.alpha * b
            bn += g * g
    return {i: weight(i) for i in z if weight(i)}, bias()


@pytest.mark.parametrize("l1", [0.0, 0.5, 3.0])
def test_updates_are_those_of_a_plain_loop(l1):
    rng = np.random.default_rng(4)
    examples = [np.unique(rng.integers(0, 40, rng.integers(0, 12))).astype(np.int32) for _ in range(120)]
    labels = np.array([int(3 in e or 7 in e) for e in examples])
    s = T.Settings(bits=6, alpha=1.5, l1=l1, l2=0.3, epochs=2, positive_weight=2.0, min_examples=2)
    want, bias = plain_ftrl([e.tolist() for e in examples], labels, s)
    got, b = T.ftrl(list(examples), labels, s)
    assert b == pytest.approx(bias)
    assert got == pytest.approx(want)
    assert l1 < 3 or len(got) < 40


def test_predict(spark):
    bad, good = "you vile nasty thing", "a calm day by the sea"
    rows = [(i, f"{bad if i % 2 else good} {i}", "x", i) for i in range(200)]
    rows += [(500, None, "x", 1), (501, "", "x", 1), (502, bad + " lorem" * 50_000, "x", 1), (None, bad, "x", 1), (1, good, "y", 2)]
    rows += [(7, bad + " 7", "x", 1)] * 40  # a labelled id that holds many rows
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, words string, label bigint").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(150)] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    s = T.Settings(l1=1.0)
    got = T.predict(docs, labels, F.lit(True), s)
    assert got.columns == [*docs.columns, "toxic_score"] and got.count() == len(rows)
    scores = {r.doc_id: r.toxic_score for r in got.where("doc_id >= 150 OR doc_id IS NULL").collect()}
    assert all((scores[i] >= 0.5) == bool(i % 2) for i in range(150, 200))
    assert scores[502] >= 0.5 and scores[None] >= 0.5 and scores[500] == scores[501]
    assert T.predict(docs.where("false"), labels, F.lit(True), s).count() == 0
    nothing = T.predict(docs, labels.where("false"), F.lit(True), s)
    assert {r.toxic_score for r in nothing.collect()} == {0.5}
