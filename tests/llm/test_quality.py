"""Quality rules and the positive-unlabelled learner against plain Python."""

import collections
import math
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import quality_rules
from strata.llm import text as X

TEXTS = {
    1: "Good words are here and Good words are common here",
    2: "good words and more of them are common",
    3: "bad spam bad spam bad spam",
    4: "spam of a bad kind and good words",
    5: "one",
    6: "",
    7: None,
}


def xx(data: bytes, seed: int = 42) -> int:
    return xxhash.xxh64(data, seed=seed).intdigest()


def grams(text, n):
    """Buckets as Spark's xxhash64 gives them: words, then pairs, each hash chained to the one before."""
    hashes = [xx(w.lower().encode()) for w in (text or "").split()]
    signed = lambda h: h - (1 << 64) if h >= 1 << 63 else h
    pairs = [xx(struct.pack("<Q", b), xx(struct.pack("<Q", a))) for a, b in zip(hashes, hashes[1:])]
    return [signed(h) % n for h in hashes] + [signed(h) % n + n for h in pairs]


@pytest.mark.parametrize("size", [16, 1 << 18])
def test_score_is_the_mean_log_ratio_of_both_models(spark, size):
    docs = spark.createDataFrame(list(TEXTS.items()), "doc_id bigint, text string").repartition(3)
    s = quality_rules.Settings(buckets=size, min_words=1)
    got = {r.doc_id: r for r in quality_rules.judge(docs, docs.where("doc_id < 3").select("doc_id"), s).collect()}
    raw, target = collections.Counter(), collections.Counter()
    for i, text in TEXTS.items():
        raw.update(grams(text, size))
        if i < 3:
            target.update(grams(text, size))
    share = sum(target.values()) / sum(raw.values())
    ratio = {b: math.log((target[b] + 1) / (max(n - 1, 0) * share + 1)) for b, n in raw.items()}
    for i, text in TEXTS.items():
        own = grams(text, size)
        want = sum(ratio[b] for b in own) / max(len(own), 1)
        assert got[i].score == pytest.approx(want, abs=1e-12)
        assert got[i].kept == (bool(own) and want >= s.threshold and not got[i].base_failed)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13])
def test_window_hashes_tell_windows_apart(spark, n):
    rng = np.random.default_rng(n)
    words = [str(w) for w in rng.integers(0, 3, 200)]
    row = spark.range(1).select(quality_rules.window_hashes(F.array(*map(F.lit, words)), n).alias("h")).first()
    windows = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    assert len(row.h) == len(windows)
    assert len(set(zip(windows, row.h))) == len(set(windows)) == len(set(row.h))
    short = spark.range(1).select(F.size(quality_rules.window_hashes(F.array(F.lit("a")), n)).alias("n")).first()
    assert short.n == (1 if n == 1 else 0)


def test_a_document_with_both_labels_is_not_trusted(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, 1), (3, 0), (None, 1), (4, None)], "doc_id bigint, quality int")
    one = X.labelled_sample(labels, "quality", F.lit(True), 10, only=1)
    assert [tuple(r) for r in one.collect()] == [(2, 1)]
    assert {tuple(r) for r in X.labelled_sample(labels, "quality", F.lit(True), 10).collect()} == {(1, 0), (2, 1), (3, 0)}
    assert X.labelled_sample(labels, "quality", F.lit(True), 1, only=1).count() == 1


def test_grams_are_counted_in_generated_code_from_words_made_once(spark, tmp_path):
    spark.createDataFrame(list(TEXTS.items()), "doc_id bigint, text string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    learnt = quality_rules.log_ratios(docs, docs.select("doc_id"), quality_rules.Settings(buckets=16))
    learnt.collect()
    execution = learnt._jdf.queryExecution()
    assert execution.optimizedPlan().toString().count("split(") == 1
    final = execution.executedPlan().toString().split("== Initial Plan ==")[0]
    explodes = [line for line in final.split("\n") if " Generate " in line]
    # The explosion of an array made by lambdas ran outside generated code, as did its buckets.
    assert explodes and all("*(" in line for line in explodes)


@pytest.mark.parametrize("n", [2, 4, 8])
def test_repeated_windows_are_found_at_any_distance_and_told_by_case(spark, n):
    rng = np.random.default_rng(n)
    window = [f"a{k}" for k in range(n)]
    texts = [window + window, window + ["x"] + window, window[1:] + window, ["b"] * (n + 1), ["b"] * n, window]
    texts += [window + [w.upper() for w in window], window + [w.upper() for w in window[:1]] + window[1:]]
    texts += [[str(w) for w in rng.integers(0, k, 60)] for k in (2, 3, 5, 9) for _ in range(8)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    rows = quality_rules.judge(docs, docs.select("doc_id"), quality_rules.Settings(buckets=16, window=n))
    got = {r.doc_id: r.n_repeat_words for r in rows.collect()}
    for i, words in enumerate(texts):
        windows = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]
        times = collections.Counter(windows)
        assert got[i] == len({k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(n)}), words
