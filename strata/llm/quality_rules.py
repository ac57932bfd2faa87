"""Quality rules: text statistics, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word n-grams (single words and pairs, lower case) are counted in one
pass: that of trusted target documents and that of the raw corpus. A document's score is the mean
over its n-grams of log p(target) - log p(raw), so it does not grow with length, and the document
is kept if the score reaches a fixed threshold. Words and pairs have spaces of their own, of
``buckets`` buckets each, so pairs (most of them rare) do not blur the words. Counts go by bucket,
so what is shuffled and what every task gets is bounded by the number of buckets, whatever the
corpus.

Defined cases: null and empty texts have no words and fail the base rules. A text with words has
n-grams, so its score is defined; a text without words scores 0. Each row is judged by its own
text, also if ids repeat. Without trusted documents the two models are equal and all scores 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import text as X

SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18
    threshold: float = -0.25
    window: int = 8
    min_words: int = 20
    max_repeat_percent: int = 30
    most_trusted: int = 50_000


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    with_word = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(X.SPACE)) != "")
    return X.let(with_word, lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


def _covered(hashes: Column, n: int) -> Column:
    """How many words lie in a window whose hash occurs twice or more.

    Sorted by hash, equal windows are neighbours; their places in order are then joined up, each
    adding the words that the one before it has not covered.
    """

    def equal(pairs, p, k):
        before, after = F.get(pairs, k - 1), F.get(pairs, k + 1)
        same = (before["hash"] == p["hash"]) | (after["hash"] == p["hash"])
        return F.when(F.coalesce(same, F.lit(False)), p["at"])

    pairs = F.array_sort(
        F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
    )
    places = X.let(pairs, lambda all_: F.transform(all_, lambda p, k: equal(all_, p, k)))
    ordered = F.array_sort(F.filter(places, lambda p: p.isNotNull()))
    zero = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))

    def add(state, at):
        words = state["words"] + at + n - F.greatest(state["end"], at)
        return F.struct(words.alias("words"), (at + n).alias("end"))

    return F.aggregate(ordered, zero, add, lambda state: state["words"])


def _side_by_side(left: Column, right: Column, gap: int) -> Column:
    """The hash of each element with the one of ``right`` that is ``gap`` places on."""

    def pairs(a: Column, b: Column) -> Column:
        n = F.greatest(F.size(b) - gap, F.lit(0))
        return F.zip_with(F.slice(a, 1, n), F.slice(b, gap + 1, n), lambda x, y: F.xxhash64(x, y))

    if left is right:
        return X.let(left, lambda a: pairs(a, a))
    return X.let(left, lambda a: X.let(right, lambda b: pairs(a, b)))


def window_hashes(words: Column, n: int) -> Column:
    """A hash of each n-word window. Windows of twice the length are put together from two halves, so a
    word is hashed once and a window costs as many steps as ``n`` has binary digits, not ``n``."""
    now, size = F.transform(words, lambda w: F.xxhash64(w)), 1
    done, length = None, 0
    while True:
        if n & size:
            done, length = (now if done is None else _side_by_side(done, now, length)), length + size
        if 2 * size > n:
            return done
        now, size = _side_by_side(now, now, size), 2 * size


def repeated_words(words: Column, n: int) -> Column:
    """Words in n-word windows found twice or more in the text, the first included."""
    counted = X.let(
        window_hashes(words, n),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            _covered(h, n)
        ),
    )
    return F.when(F.size(words) > n, counted).otherwise(F.lit(0))


def may_repeat(fours: Column, n: int) -> Column:
    """Whether a text can hold an n-word window twice, by the hashes of its four-word windows.

    Of a window found again, the n - 3 four-word windows in it are found again too. Few texts hold so many.
    """
    if n < 4:
        return F.lit(True)
    return F.size(fours) - F.size(F.array_distinct(fours)) > n - 4


def word_hashes(words: Column) -> Column:
    """The hash of each word in lower case."""
    return F.transform(words, lambda w: F.xxhash64(F.lower(w)))


def bucket(hashed: Column, n: int, first: int = 0) -> Column:
    """Words have the buckets below ``n``, pairs of neighbours those from ``n`` to 2 ``n``."""
    return (F.pmod(hashed, F.lit(n)) + first).cast("int")


def buckets(words: Column, n: int) -> Column:
    """All buckets of a text in one array, as ``log_ratios`` counts them and ``judge`` adds them up."""

    def both(hashes: Column) -> Column:
        pairs = F.transform(_side_by_side(hashes, hashes, 1), lambda h: bucket(h, n, n))
        return F.concat(F.transform(hashes, lambda h: bucket(h, n)), pairs)

    return X.let(word_hashes(words), both)


def log_ratios(docs: DataFrame, trusted: DataFrame, s: Settings) -> DataFrame:
    """One row, one array: log p(target) - log p(raw) of each bucket.

    Raw counts are scaled to the size of the target before one is added to both, so the two are
    smoothed alike, and a gram too rare to tell stays near 0 however many buckets there are. One is
    taken off the raw counts, as each text that is judged is itself among them: a gram found in
    this text alone says nothing against it.
    """
    wanted = trusted.select(F.col("doc_id").alias("trusted_id")).distinct()
    rows = docs.join(F.broadcast(wanted), F.col("doc_id") == F.col("trusted_id"), "left")
    hashed = rows.select(
        F.col("trusted_id").isNotNull().alias("target"),
        word_hashes(X.words(F.col("text"))).alias("hashes"),
    )
    # The inner form would filter by the size of the array first and so make each array twice.
    each = hashed.select("target", "hashes", F.posexplode_outer("hashes").alias("at", "word"))
    # Buckets are made row by row, where Spark generates code, and not in lambdas, where it does not.
    after = F.get("hashes", F.col("at") + 1)
    pair = F.when(after.isNotNull(), bucket(F.xxhash64("word", after), s.buckets, s.buckets))
    single = bucket(F.col("word"), s.buckets)
    grams = each.select("target", F.stack(F.lit(2), single, pair).alias("bucket")).where("bucket IS NOT NULL")
    counts = grams.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("raw"), F.count_if("target").alias("target")
    )
    every = docs.sparkSession.range(2 * s.buckets).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counts, "bucket", "left").select(
        "bucket",
        F.coalesce("raw", F.lit(0)).alias("raw"),
        F.coalesce("target", F.lit(0)).alias("target"),
    )
    one = full.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("cells"),
        (F.sum("target") / F.greatest(F.sum("raw"), F.lit(1))).alias("share"),
    )

    def ratio(cell):
        expected = F.greatest(cell["raw"] - 1, F.lit(0)) * F.col("share")
        return F.log((cell["target"] + 1) / (expected + 1))

    learnt = F.transform("cells", ratio)
    return one.select(learnt.alias("ratios"))


def judge(docs: DataFrame, trusted: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``docs`` (doc_id, text) with the statistics, ``base_failed``, ``score`` and ``kept``.

    ``trusted`` (doc_id) is a bounded sample of trusted documents; it is broadcast.
    """
    rows = docs.select("doc_id", "text")
    # The one row of ratios is a scalar subquery: computed once and sent to each task.
    ratios = log_ratios(rows, trusted, s).scalar()
    text, words = X.filled(F.col("text")), F.col("words")
    read = rows.select("doc_id", text.alias("text"), X.words(text).alias("words"))
    hashed = read.select("*", word_hashes(words).alias("hashes"))
    paired = hashed.select("*", _side_by_side(F.col("hashes"), F.col("hashes"), 1).alias("pairs"))
    fours = paired.select("*", _side_by_side(F.col("pairs"), F.col("pairs"), 2).alias("fours"))
    measured = fours.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        duplicate_lines(F.col("text")).cast("bigint").alias("n_dup_lines"),
        F.when(may_repeat(F.col("fours"), s.window), repeated_words(words, s.window))
        .otherwise(F.lit(0))
        .cast("bigint")
        .alias("n_repeat_words"),
        "hashes",
        "pairs",
    )

    def add(first: int, r: Column):
        return lambda sum_, h: sum_ + F.get(r, bucket(h, s.buckets, first))

    total = X.let(
        F.col("ratios"),
        lambda r: F.aggregate("pairs", F.aggregate("hashes", F.lit(0.0), add(0, r)), add(s.buckets, r)),
    )
    scored = measured.withColumn("ratios", ratios).withColumn(
        "score", total / F.greatest(F.size("hashes") + F.size("pairs"), F.lit(1))
    )
    many = 100 * F.col("n_repeat_words") > s.max_repeat_percent * F.col("n_words")
    failed = (F.col("n_words") < s.min_words) | many
    return scored.drop("hashes", "pairs", "ratios").withColumns(
        {"base_failed": failed, "kept": ~failed & (F.col("score") >= s.threshold)}
    )
