"""URL verdicts: prefix rules first, then logistic regression on hashed character n-grams.

``parts`` takes a url apart, ``rule_of`` finds the longest rule that fits, ``classify`` learns from
a small labelled table and judges every url. All of it is DataFrame operations: the learner is
Spark's own logistic regression over Spark's hashed features.

Defined cases: a null url, or one without ``://``, has an empty host and path. No rule fits an
empty host. The empty strings have no n-grams, so their verdict is that of the intercept. Without
labelled rows every url is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import text as X

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; the host in lower case."""
    rest = X.filled(F.get(F.split(url, "://", 2), F.lit(1)))
    host = X.lower_ascii(F.regexp_extract(rest, r"\A([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def fits(rule: UrlRule, host: Column, path: Column) -> Column:
    """The host is the rule's or below it, and the path starts with the rule's."""
    below = (host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))
    return below & F.startswith(path, F.lit(rule.path))


def rule_of(rules: Sequence[UrlRule], host: Column, path: Column) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, else nulls. Rules are a short list."""
    # From the shortest to the longest, so that the longest is asked first.
    order = sorted(rules, key=lambda rule: (len(rule.name), rule.name))

    def choose(value):
        none = F.lit(None).cast("string")
        return reduce(
            lambda rest, r: F.when(fits(r, host, path), F.lit(value(r))).otherwise(rest), order, none
        )

    return choose(lambda r: r.name), choose(lambda r: r.verdict)


def ngrams(value: Column, n: int) -> Column:
    """The distinct character n-grams of a string; none if it is shorter."""
    # A split at the empty pattern gives one string per character.
    characters = F.filter(F.split(value, ""), lambda c: c != "")
    starts = F.sequence(F.lit(0), F.char_length(value) - n)
    grams = X.let(
        characters,
        lambda c: F.transform(starts, lambda i: F.concat(*[F.get(c, i + k) for k in range(n)])),
    )
    none = F.array().cast("array<string>")
    return F.when(F.char_length(value) >= n, F.array_distinct(grams)).otherwise(none)


def features(host: Column, path: Column, sizes: Sequence[int] = (2, 3)) -> Column:
    """Marked n-grams of host and path, so the same letters in the two count apart."""

    def marked(mark, value):
        grams = F.concat(*[ngrams(value, n) for n in sizes])
        return F.transform(grams, lambda g: F.concat(F.lit(mark), g))

    return F.concat(marked("h", host), marked("p", path))


def classify(
    urls: DataFrame, labelled: DataFrame, rules: Sequence[UrlRule], url: str = "url", buckets: int = 1 << 14
) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to ``row``, the row as it came.

    ``labelled`` is a small table (url, label): 1 is block. It is learnt in one partition, in a
    fixed order, so that repeated runs add the same numbers in the same order.
    """
    hashing = HashingTF(numFeatures=buckets, binary=True, inputCol="grams", outputCol="features")

    def prepared(rows, url_column):
        host, path = parts(url_column)
        split = rows.withColumns({"host": host, "path": path})
        return split.withColumn("grams", features(F.col("host"), F.col("path")))

    judged = prepared(urls.select(F.struct("*").alias("row")), F.col(f"row.`{url}`"))
    name, verdict = rule_of(rules, F.col("host"), F.col("path"))
    known = labelled.select("url", F.col("label").cast("double").alias("label")).where(
        "label IS NOT NULL"
    )
    learn = known.coalesce(1).sortWithinPartitions("url", "label")
    if learn.isEmpty():
        guess = F.lit(ALLOW)
    else:
        learner = LogisticRegression(regParam=0.01, maxIter=50, tol=1e-8)
        model = learner.fit(hashing.transform(prepared(learn, F.col("url"))))
        judged = model.transform(hashing.transform(judged))
        guess = F.when(F.col("prediction") == 1.0, BLOCK).otherwise(ALLOW)
    return judged.select(
        "row", "host", "path", name.alias("rule"), F.coalesce(verdict, guess).alias("verdict")
    )


def labelled_by_rules(
    urls: DataFrame, rules: Sequence[UrlRule], url: str = "url", most: int = 5000
) -> DataFrame:
    """A small labelled table from the rules: at most ``most`` urls that a rule judges, by hash."""
    address = urls.select(F.col(url).alias("url")).distinct()
    verdict = rule_of(rules, *parts(F.col("url")))[1]
    rows = address.select("url", (verdict == BLOCK).cast("int").alias("label"))
    return rows.where("label IS NOT NULL").orderBy(F.xxhash64("url"), "url").limit(most)
