"""What a text has to itself, and the members that a bucket lets go for it."""

import collections
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import minhash

BASE = [f"w{i}" for i in range(120)]


def variants(n, low, high, seed):
    rng = np.random.default_rng(seed)
    texts = {}
    for i in range(n):
        words = list(BASE)
        for at in rng.choice(120, rng.integers(low, high), replace=False):
            words[at] = f"v{rng.integers(0, 40)}x{at}"
        texts[i] = " ".join(words + words[:6] * (i % 3))
    return texts


def shingles(text):
    w = text.split()
    return collections.Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))


def similarity(a, b):
    x, y = shingles(a), shingles(b)
    return sum((x & y).values()) / sum((x | y).values())


@pytest.fixture
def staged(spark):
    def make(texts, buckets):
        rows = spark.createDataFrame(list(texts.items()), "id bigint, text string")
        node = F.struct(F.col("id").alias("a"), (F.col("id") * 7).alias("b")).alias("node")
        size = F.greatest(F.size(F.split("text", " ")) - 4, F.lit(1)).alias("size")
        words = rows.select(node, minhash.word_hashes(F.col("text")).alias("words"))
        both = rows.select(node, size).crossJoin(spark.range(buckets).withColumnRenamed("id", "bucket"))
        members = both.select("bucket", "node", F.struct(F.lit(0).alias("o"), "node", "size").alias("member"))
        return members, words, minhash._Stage(rows)

    return make


def test_own_is_what_no_other_member_has(staged):
    texts = {**variants(40, 1, 9, 3), 90: "one two", 91: "one two three four five six", 92: "x " * 50 + "y"}
    members, words, stage = staged(texts, 3)
    # A text that is in no bucket any more takes nothing from the others.
    members = members.where("node.a != 5 AND node.a != 91")
    open_ = {i: shingles(t) for i, t in texts.items() if i not in (5, 91)}
    among = collections.Counter(itertools.chain.from_iterable(open_.values()))
    want = {i: sum(n for g, n in s.items() if among[g] == 1) for i, s in open_.items()}
    got = minhash._own(members, words, stage).select("node.a", "own").collect()
    assert len(got) == len(want) and all(r.own == want[r.a] for r in got)
    assert minhash._own(members.where("false"), words, stage).count() == 0


def test_a_bucket_keeps_every_member_with_a_link(staged):
    s = minhash.Settings()
    texts = {**variants(60, 2, 7, 4), 80: "alone among others here now"}
    members, words, stage = staged(texts, 2)
    # Nothing is linked yet, so each node is its own class; the third bucket has one member.
    facts = minhash._own(members, words, stage).withColumn("class", F.col("node"))
    alone = members.where("bucket = 0 AND node.a = 1").withColumn("bucket", F.lit(2).cast("bigint"))
    kept = minhash._open(minhash._with_facts(members.unionAll(alone), facts), s)
    kept = {(r.bucket, r.a) for r in kept.select("bucket", "node.a").collect()}
    linked = {i for a, b in itertools.combinations(texts, 2) if similarity(texts[a], texts[b]) >= s.threshold for i in (a, b)}
    assert linked and {(b, i) for b in (0, 1) for i in linked} <= kept
    assert len(kept) < 2 * len(texts) and not any(b == 2 for b, _ in kept)


def test_lookalikes_without_a_link_are_not_all_compared(spark, monkeypatch):
    pairs = []
    compared = minhash._compared
    monkeypatch.setattr(minhash, "_compared", lambda p, n: pairs.append(p.count()) or compared(p, n))
    rng, texts = np.random.default_rng(6), {}
    for i in range(200):
        words = list(BASE)
        for at in 10 + 20 * np.arange(5) + rng.integers(0, 10, 5):
            words[at] = f"v{i}x{at}"
        texts[i] = " ".join(words)
    assert max(similarity(texts[0], texts[i]) for i in range(1, 200)) < 0.8
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = minhash.near_duplicates(docs).collect()
    assert all(r.class_id == r.doc_id for r in got) and len(got) == 200
    # Each text meets at most the four first pivots of its buckets and a few more, not all 199 others.
    assert sum(pairs) < 200 * 12


def test_a_pair_is_fetched_once_and_only_texts_still_in_a_bucket_are_moved(spark, monkeypatch):
    moved, plans, held, linked = [], [], minhash._held, minhash._linked

    def counted(members, texts, stage):
        moved.append(held(members, texts, stage))
        return moved[-1]

    def seen(pairs, texts, s):
        plans.append(linked(pairs, texts, s))
        return plans[-1]

    monkeypatch.setattr(minhash, "_held", counted)
    monkeypatch.setattr(minhash, "_linked", seen)
    texts = {**variants(60, 7, 10, 5), 500: " ".join(BASE), 501: " ".join(BASE + ["tail"])}
    texts |= {600 + i: " ".join(f"u{i}x{k}" for k in range(60)) + " a" * (i % 2) for i in range(0, 20)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    links = [p for p in itertools.combinations(texts, 2) if similarity(texts[p[0]], texts[p[1]]) >= 0.8]
    assert all(got[a] == got[b] for a, b in links if {a, b} == {500, 501})
    parent = {i: i for i in texts}
    for a, b in links:
        one, two = parent[a], parent[b]
        parent = {i: one if of == two else of for i, of in parent.items()}
    # No class holds texts that no chain of links joins.
    assert all(parent[i] == parent[of] for i, of in got.items())
    sizes = [frame.count() for frame in moved]
    assert sizes and sizes[0] < len(texts) and sizes == sorted(sizes, reverse=True)
    for plan in plans:
        assert plan._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 2
        assert "registers" in plan._jdf.queryExecution().analyzed().toString()


def near_copies(n, seed):
    """Variants of one text of 150 words with up to six words replaced."""
    rng, texts = np.random.default_rng(seed), {}
    for i in range(n):
        words = [f"w{k}" for k in range(150)]
        for at in rng.choice(150, rng.integers(1, 7), replace=False):
            words[at] = f"v{rng.integers(0, 40)}"
        texts[i] = " ".join(words)
    return texts


def linked_ids(texts, s):
    each = {i: shingles(t) for i, t in texts.items()}
    size = {i: sum(c.values()) for i, c in each.items()}
    found = []
    for a, b in itertools.combinations(texts, 2):
        same = sum((each[a] & each[b]).values())
        if same >= s.threshold * (size[a] + size[b] - same):
            found.append((a, b))
    return found


def test_no_text_with_a_link_to_another_class_is_hopeless(spark):
    s = minhash.Settings()
    rng = np.random.default_rng(8)
    texts = near_copies(60, 2)
    # Other sizes: repeated shingles, parts and lengthened copies; short texts; one alone.
    texts |= {100 + i: " ".join(texts[i].split()[: rng.integers(110, 150)]) for i in range(30)}
    texts |= {200 + i: texts[i] + " w1 w2 w3 w4 w5 w6" * int(rng.integers(1, 8)) for i in range(30)}
    texts |= {300: "one two", 301: "one two three four five six", 302: "x " * 50, 303: "x " * 60, 304: "quite alone here among them all"}
    own = {i: i if i % 3 else 0 for i in texts}  # a third of them are one class already
    rows = spark.createDataFrame([(i, own[i], t) for i, t in texts.items()], "id bigint, c bigint, text string")
    node = [F.struct(F.col(c).alias("a"), (F.col(c) * 7).alias("b")).alias(n) for c, n in (("id", "node"), ("c", "class"))]
    frame = rows.select(*node, minhash.word_hashes(F.col("text")).alias("words"))
    got = {r.a: r for r in minhash._hopeful(frame, minhash._Stage(rows), s).select("node.a", "class", "own").collect()}
    wanted = {i for a, b in linked_ids(texts, s) if own[a] != own[b] for i in (a, b)}
    assert len(wanted) > 60 and {302, 303} <= wanted and wanted <= set(got)
    assert not {300, 301, 304} & set(got)
    each = {i: shingles(t) for i, t in texts.items()}
    among = collections.Counter(itertools.chain.from_iterable(each.values()))
    assert all(r.own == sum(n for g, n in each[i].items() if among[g] == 1) for i, r in got.items())
    assert all(getattr(r, "class").a == own[i] for i, r in got.items())


def test_near_copies_around_one_text_are_not_all_compared(spark, monkeypatch):
    pairs, linked = [], minhash._linked
    monkeypatch.setattr(minhash, "_linked", lambda p, t, s: pairs.append(p.count()) or linked(p, t, s))
    texts = near_copies(400, 6)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    parent = {i: i for i in texts}
    for a, b in linked_ids(texts, minhash.Settings()):
        one, two = sorted((parent[a], parent[b]))
        parent = {i: one if of == two else of for i, of in parent.items()}
    # No class joins what links do not, and all but a few of the links are found.
    assert all(parent[i] == parent[of] for i, of in got.items())
    assert len(set(got.values())) <= len(set(parent.values())) + 4
    # 3,666 after the first pivots; 7,762 where a bucket lets only texts go that have much to themselves.
    assert sum(pairs[1:]) < 5000


def test_a_worker_looks_at_a_bounded_slice_of_words(spark):
    sizes = np.array([0, 5, 1 << 18, 0, *[700] * 1000, 1 << 17, 3])
    parts = list(minhash._parts(sizes))
    assert [p[0] for p in parts] == [0, *(p[1] for p in parts[:-1])] and parts[-1][1] == len(sizes)
    assert all(low == sizes[:start].sum() and high == sizes[:stop].sum() for start, stop, low, high in parts)
    assert all(high - low <= 1 << 17 or sizes[start:stop].max() == high - low for start, stop, low, high in parts)


def test_pairs_go_through_one_python_function(spark):
    docs = spark.createDataFrame([(i, " ".join(BASE) + " t" * i) for i in range(3)], "a bigint, text string")
    node = F.struct("a", F.col("a").alias("b"))
    sketch = minhash.sketches(F.col("text"), minhash.Settings())
    texts = docs.select(node.alias("node"), minhash.word_hashes(F.col("text")).alias("words"), sketch.registers.alias("registers"))
    texts = minhash._Stage(docs).kept(texts)
    pairs = texts.select("node").join(texts.select(F.col("node").alias("pivot")), F.col("node.a") < F.col("pivot.a"))
    plan = minhash._linked(pairs, texts, minhash.Settings())
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    got = {(r.node.a, r.pivot.a): r.similarity for r in plan.collect()}
    full = {r.a: r.text for r in docs.collect()}
    assert got == {p: pytest.approx(similarity(full[p[0]], full[p[1]])) for p in ((0, 1), (0, 2), (1, 2))}
