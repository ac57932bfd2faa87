"""The operators against plain Python on small tables with awkward rows."""

import base64
import collections
import hashlib
import itertools
import math
import re
import zipfile

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from strata.llm import (
    bpe,
    decontaminate,
    kneser_ney,
    line_dedup,
    minhash,
    quality_pu,
    quality_rules,
    toxicity,
    url_filter,
    warc,
)
from strata.llm import text as X

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
LONG = " ".join(f"w{i * i % 977}" for i in range(3000))
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "A line that is shared by many\nown one"),
    (5, "a line that is SHARED by many \nown two"), (6, "  a line that is shared by many"),
    (6, "  a line that is shared by many"), (7, LONG), (8, LONG + " tail"), (9, "übel Ärger é\x85 x"),
    (None, "a line that is shared by many\nnull id"), (10, LONG.replace("w4 ", "w5 ", 3)),
    (11, "one two three"), (12, "one two three"),
]


@pytest.fixture(scope="module")
def docs(spark):
    # Columns that clash with names used inside the operators.
    rows = [(*row, "k", "p", 1) for row in TEXTS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, key string, print string, pos int")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def by_row(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_line_dedup(docs, empty):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = collections.defaultdict(set)
    for doc_id, text in TEXTS:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc_id)
    want = []
    for doc_id, text in TEXTS:
        lines, left = (text or "").split("\n"), []
        for line in lines:
            of = holders[key(line)]
            top = max(of, key=lambda i: (i is not None, i or 0))
            if len(key(line)) < 20 or len(of) < 3 or doc_id == top:
                left.append(line)
        want.append((doc_id, "\n".join(left), len(lines), len(lines) - len(left)))
    got = line_dedup.dedup_lines(docs)
    assert by_row(got, "doc.doc_id", "kept", "n_lines", "n_dropped") == sorted(want, key=repr)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_quality_rules(docs, empty):
    got = quality_rules.judge(docs, docs.where("doc_id = 7").select("doc_id"))
    for row in got.collect():
        texts = [t or "" for i, t in TEXTS if i == row.doc_id]
        words = [WORD.findall(t) for t in texts]
        assert row.n_words in {len(w) for w in words}
        windows = collections.Counter(tuple(words[0][k : k + 8]) for k in range(len(words[0]) - 7))
        covered = {
            k + d for k in range(len(words[0]) - 7) for d in range(8) if windows[tuple(words[0][k : k + 8])] > 1
        }
        assert row.n_repeat_words == len(covered)
        assert row.base_failed == (row.n_words < 20 or 100 * len(covered) > 30 * row.n_words)
        assert not (row.base_failed and row.kept)
    assert got.count() == len(TEXTS)
    assert quality_rules.judge(empty, empty.select("doc_id")).count() == 0


def test_quality_score_does_not_fade_as_the_corpus_grows(spark):
    """Rare words around 4,000 good and 4,000 bad ones: 300,000 rare words and more pairs."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(3000):
        common = [f"{'good' if i % 2 else 'bad'}{k}" for k in rng.integers(0, 4000, 100)]
        rows.append((i, " ".join(w for k, c in enumerate(common) for w in (c, f"rare{i}x{k}"))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    trusted = docs.where("doc_id % 2 = 1 AND doc_id < 2400").select("doc_id")
    got = quality_rules.judge(docs, trusted).where("doc_id >= 2400 AND NOT base_failed")
    kept = {(r.good, r.kept): r["count"] for r in got.groupBy((F.col("doc_id") % 2).alias("good"), "kept").count().collect()}
    assert kept == {(1, True): 300, (0, False): 300}


def test_words_and_pairs_have_buckets_of_their_own(spark):
    row = spark.range(1).select(quality_rules.buckets(F.array(*map(F.lit, "abcdefgh")), 4).alias("b")).first()
    assert {b // 4 for b in row.b[:8]} == {0} and {b // 4 for b in row.b[8:]} == {1} and len(row.b) == 15


def test_decontamination_tolerates_substitutions(spark, empty):
    item = " ".join(f"t{i}" for i in range(30))
    words = item.split()
    words[7], words[16] = "x", "y"
    rows = [(1, f"before {' '.join(words)} after"), (2, "nothing here"), (3, None), (4, item[:12]), (1, item)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame([(9, item), (9, item), (8, None), (7, "short one")], "item_id bigint, text string")
    assert by_row(decontaminate.leaks(docs, items), "doc_id", "item_id") == [(1, 9)]
    assert by_row(decontaminate.leaks(docs, items, most_seeds=20), "doc_id", "item_id") == [(1, 9)]
    assert decontaminate.leaks(empty, items).count() == 0
    assert decontaminate.leaks(docs, items.where("false")).count() == 0


def test_decontamination_finds_every_pattern_that_agree_allows(spark):
    items, docs, want = [], [], set()
    for n in (*range(1, 15), 20):
        words = [f"i{n}w{k}" for k in range(n)]
        items.append((n, " ".join(words)))
        checked = min(n, 13)
        differ = checked - math.ceil(0.8 * checked)
        for places in itertools.combinations(range(checked), differ):
            own = [f"other{k}" if k in places else words[k] for k in range(checked)]
            # At the start and the end of a text what differs may also be missing.
            for text in ("front " + " ".join(own) + " back", " ".join(own).removeprefix("other0 ")):
                want.add((len(docs), n))
                docs.append((len(docs), text))
        docs.append((len(docs), " ".join(words[k] if k > differ else "no" for k in range(checked))))
    items += [(50, "这是中文句子"), (51, "短句")]
    want |= {(len(docs), 50), (len(docs), 51)}
    docs.append((len(docs), "前面这是中文句子，后面还有短句在这里"))
    got = decontaminate.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    assert set(by_row(got, "doc_id", "item_id")) == want


def test_bpe_round_trip_and_cuts(docs):
    ids = bpe.encode(F.col("text"), RANKS, PATTERN)
    rows = docs.select("text", ids.alias("ids")).withColumn("back", bpe.decode(F.col("ids"), RANKS, PATTERN))
    codec = bpe.encoding(RANKS, PATTERN)
    for row in rows.collect():
        assert row.ids == codec.encode_ordinary(row.text or "")
        assert bytes(row.back) == (row.text or "").encode()
    both = docs.select("text", bpe.round_trip(F.col("text"), RANKS, PATTERN).alias("c")).collect()
    for row in both + docs.where("false").select("text", bpe.round_trip(F.col("text"), RANKS, PATTERN).alias("c")).collect():
        assert row.c.ids == codec.encode_ordinary(row.text or "")
        assert bytes(row.c.bytes) == (row.text or "").encode()
    for text in (LONG, "a" + " " * 5000 + "b", " " * 3000, "x\n" * 4000, "é\x85" * 900 + "\x1c" * 1500, "z" * 9000):
        assert bpe.encode_text(text, RANKS, PATTERN, 64) == codec.encode_ordinary(text)
    huge = "a" + " " * 2_000_000
    assert codec.decode_bytes(bpe.encode_text(huge, RANKS, PATTERN)) == huge.encode()
    assert base64.b64decode(open(RANKS, "rb").readline().split()[0])


def test_bpe_slices_keep_the_rows_in_order(spark):
    texts = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat(concat('word ', id, ' '), 800) AS text")
    coded = texts.select("id", "text", bpe.round_trip(F.col("text"), RANKS, PATTERN).alias("c"))
    wrong = coded.where("string(c.bytes) != text OR size(c.ids) < 800 OR c IS NULL")
    assert wrong.count() == 0 and coded.selectExpr("sum(size(c.ids)) AS n").first().n > 2 * bpe.SLICE
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [bytes(r.b) for r in nulls.select(bpe.decode(F.col("ids"), RANKS, PATTERN).alias("b")).collect()] == [b"", b""]


def similarity(a, b):
    def shingles(text):
        w = WORD.findall((text or "").translate(LOWER))
        return collections.Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else {}

    x, y = shingles(a), shingles(b)
    top = sum((x | y).values()) if x and y else 0
    return sum((x & y).values()) / top if top else 0.0


def test_near_duplicates(docs, empty):
    got = dict(by_row(minhash.near_duplicates(docs).where("doc_id IS NOT NULL").distinct(), "doc_id", "class_id"))
    texts = {i: t for i, t in TEXTS if i is not None}
    for a in texts:
        linked = [b for b in texts if a == b or similarity(texts[a], texts[b]) >= 0.8]
        assert got[a] == min(linked)
    assert minhash.near_duplicates(empty).count() == 0


def test_no_link_is_lost_among_lookalikes(spark):
    """Variants of one text, about half of them just below and half just above the threshold."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(150):
        words = list(base)
        for at in rng.choice(120, rng.integers(1, 6), replace=False):
            words[at] = f"v{i}x{at}"
        texts[i] = " ".join(words)
    pairs = [(a, b) for a in texts for b in texts if a < b and similarity(texts[a], texts[b]) >= 0.8]
    want = {i: i for i in texts}
    for _ in texts:
        new = dict(want)
        for a, b in pairs:
            new[a] = new[b] = min(new[a], new[b])
        if new == want:
            break
        want = new
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert dict(by_row(minhash.near_duplicates(docs), "doc_id", "class_id")) == want
    assert 1 < len(set(want.values())) < 150


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    a = np.repeat(rng.integers(1, 1 << 60, 40), rng.integers(1, 9, 40))
    b = np.concatenate([a[: len(a) * 3 // 4], rng.integers(1, 1 << 60, 20)])
    doc = np.concatenate([np.zeros(len(a), int), np.ones(len(b), int)])
    value = np.concatenate([a, b]).astype(np.uint64)
    times = minhash.signatures(*minhash.weighted(doc, value), 2, 4096)
    x, y = collections.Counter(a.tolist()), collections.Counter(b.tolist())
    want = sum((x & y).values()) / sum((x | y).values())
    assert abs((times[0] == times[1]).mean() - want) < 0.04


def test_url_rules_and_parts(spark):
    rules = (
        url_filter.UrlRule("allow", "org", "/"), url_filter.UrlRule("block", "example.org", "/es/"),
        url_filter.UrlRule("block", "com", "/de/"),
    )
    urls = [None, "no scheme", "http://A.Example.org/es/1?x#y", "http://org", "x://badexample.org/es/", "h://a.com/de/#z"]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    got = url_filter.classify(rows, url_filter.labelled_by_rules(rows, rules), rules)
    assert by_row(got, "row.page_id", "host", "path", "rule")[:6] == [
        (0, "", "", None), (1, "", "", None), (2, "a.example.org", "/es/1", "example.org/es/"),
        (3, "org", "", None), (4, "badexample.org", "/es/", "org/"), (5, "a.com", "/de/", "com/de/"),
    ]
    assert {r.verdict for r in got.collect()} <= {"allow", "block"}
    none = url_filter.classify(rows, url_filter.labelled_by_rules(rows, ()), ())
    assert {r.verdict for r in none.collect()} == {"allow"}


def test_warc_round_trip(spark, folder):
    copy = "x" * 150
    rows = [(5, "http://a/\n%", copy), (3, None, copy), (4, "u", copy), (9, "u", "tiny"), (8, "u", "tiny"), (1, "u", None),
            (2, "u", "é" * 70)]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id bigint, url string, html string, payload int")
    packages = warc.archive_pages(spark, pages, folder)
    found = warc.resolve(warc.read_records(packages, span_bytes=1))
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        again = html == copy and page != 3
        kind = "revisit" if again else "response"
        want.append((str(page), len(data), hashlib.sha256(data).hexdigest(), kind, "3" if again else None))
    assert by_row(found, *found.columns) == sorted(want, key=repr)
    urls = dict(by_row(warc.read_records(packages), "record_id", "target_uri"))
    assert urls["5"] == "http://a/\n%" and urls["3"] is None
    for row in packages.collect():
        with zipfile.ZipFile(row.path.removeprefix("file:")) as package:
            assert package.testzip() is None
            assert {i.compress_type for i in package.infolist()} == {zipfile.ZIP_STORED}
    assert warc.read_records(warc.archive_pages(spark, pages.where("false"), f"{folder}/e")).count() == 0


def test_kneser_ney_equals_plain_counts(docs, empty):
    model = kneser_ney.fit(docs)
    got = docs.select("text", kneser_ney.score(F.col("text"), model).alias("s")).collect()
    rows = [WORD.findall((t or "").translate(LOWER)) + ["\n"] for _, t in TEXTS]
    words = collections.Counter(w for r in rows for w in r)
    pairs = collections.Counter(p for r in rows for p in zip(["^"] + r, r))
    behind = collections.Counter(b for _, b in pairs)
    tally = lambda c: [sum(n == k for n in c.values()) for k in (1, 2, 3, 4)]
    d2, d1 = kneser_ney.discounts(tally(pairs)), kneser_ney.discounts(tally(behind))
    off = lambda d, n: 0.0 if n == 0 else d[min(n, 3) - 1]
    share = sum(off(d1, n) for n in behind.values()) / len(pairs)
    after, weight = collections.Counter(), collections.Counter()
    for (a, _), n in pairs.items():
        after[a] += n
        weight[a] += off(d2, n)

    def probability(a, w):
        low = max(behind[w] - off(d1, behind[w]), 0) / len(pairs) + share / (len(words) + 1)
        return max(pairs[a, w] - off(d2, pairs[a, w]), 0) / after[a] + weight[a] / after[a] * low

    for row in got:
        tokens = WORD.findall((row.text or "").translate(LOWER)) + ["\n"]
        want = sum(math.log10(probability(a, w)) for a, w in zip(["^"] + tokens, tokens))
        base = sum(math.log10((words[w] + 1) / (sum(words.values()) + len(words) + 1)) for w in tokens)
        assert math.isclose(row.s.score, want, rel_tol=1e-9) and math.isclose(row.s.base_score, base, rel_tol=1e-9)
        assert (row.s.n_tokens, row.s.n_known) == (len(tokens), len(tokens))
    assert kneser_ney.fit(empty).tokens == 0
    none = docs.select(kneser_ney.score(F.col("text"), kneser_ney.fit(empty)).alias("s"))
    assert all(r.s.n_known == 0 for r in none.collect())


@pytest.mark.parametrize("order", [3, 4])
def test_kneser_ney_of_higher_order(spark, docs, order):
    model = kneser_ney.fit(docs, order=order)
    rows = [WORD.findall((t or "").translate(LOWER)) + ["\n"] for _, t in TEXTS]
    words = collections.Counter(w for r in rows for w in r)
    padded = lambda r: ["^"] * (order - 1) + r
    grams = {order: collections.Counter(g for r in rows for g in zip(*[padded(r)[k:] for k in range(order)]))}
    for n in range(order - 1, 0, -1):
        grams[n] = collections.Counter(g[1:] for g in grams[n + 1])
    d = {n: kneser_ney.discounts([sum(c == k for c in grams[n].values()) for k in (1, 2, 3, 4)]) for n in grams}
    off = lambda n, c: 0.0 if c == 0 else d[n][min(c, 3) - 1]
    total, weight = collections.Counter(), collections.Counter()
    for n in grams:
        for g, c in grams[n].items():
            total[n, g[:-1]] += c
            weight[n, g[:-1]] += off(n, c)

    def probability(g):
        n = len(g)
        low = probability(g[1:]) if n > 1 else 1 / (len(words) + 1)
        if not total[n, g[:-1]]:
            return low
        c = grams[n][g]
        return (max(c - off(n, c), 0) + weight[n, g[:-1]] * low) / total[n, g[:-1]]

    texts = [(t,) for _, t in TEXTS] + [("one three two unheard of w4 three",), ("own one own two shared by w5",)]
    frame = spark.createDataFrame(texts, "text string")
    for row in frame.select("text", kneser_ney.score(F.col("text"), model).alias("s")).collect():
        tokens = padded(WORD.findall((row.text or "").translate(LOWER)) + ["\n"])
        want = sum(math.log10(probability(tuple(tokens[k : k + order]))) for k in range(len(tokens) - order + 1))
        assert math.isclose(row.s.score, want, rel_tol=1e-9)


def labelled(spark, column):
    rows, labels = [], []
    for i in range(200):
        good = i % 2
        body = " ".join(f"word{(i * 7 + k * k) % 301}" for k in range(60))
        rows.append((i, body if good else (f"{body} nasty vile" if column == "toxic" else "spam " * 50)))
        labels.append((i, good if column == "quality" else 1 - good))
    rows += [(1000, None), (1001, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return docs, spark.createDataFrame(labels, f"doc_id bigint, {column} int")


def test_toxicity_held_out(spark):
    docs, labels = labelled(spark, "toxic")
    fold = F.col("doc_id") % 10 < 6
    got = dict(by_row(toxicity.predict(docs, labels, fold), "doc_id", "toxic_score"))
    assert all((got[i] >= 0.5) == (i % 2 == 0) for i in range(200) if i % 10 >= 6)
    assert got[1000] == got[1001]
    none = toxicity.predict(docs, labels.where("false"), fold)
    assert {r.toxic_score for r in none.collect()} == {0.5}


def test_quality_held_out(spark):
    docs, labels = labelled(spark, "quality")
    fold = F.col("doc_id") % 10 < 6
    weights = quality_pu.fit(docs, labels, fold)
    got = dict(by_row(docs.select("doc_id", quality_pu.score(F.col("text"), weights).alias("p")), "doc_id", "p"))
    assert all((got[i] >= 0.5) == (i % 2 == 1) for i in range(200) if i % 10 >= 6)
    assert got[1000] == got[1001] and 0 <= got[1000] <= 1
    assert not quality_pu.fit(docs, labels.where("false"), fold).any()


def test_remainder_of_a_null_id(spark):
    row = spark.createDataFrame([(None,)], "doc_id bigint").select(X.remainder(F.col("doc_id"), 3).alias("r")).first()
    assert row.r == 0
