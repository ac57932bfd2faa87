"""Near-duplicate classes by BagMinHash signatures, banding, and exact multiset overlap.

A text is the multiset of its five-word shingles (words ``[^\\x20\\x09-\\x0D]+``, A-Z in lower case; a
text of fewer words is one shingle). Two texts are linked if the weighted Jaccard similarity of
their multisets, sum of minima over sum of maxima, is at least ``threshold``. A class is a connected
set of links; its id is the smallest document id in it.

1. Equal texts are one node from the start, whatever their number.
2. BagMinHash: the weights 1, 2, 3, ... of a shingle are cut into the strips (0,1], (1,2], (2,4], ...
   Each strip is a Poisson process of a rate equal to its width, fixed by shingle and strip. A point
   has a time, a register and a weight level; a text takes the points whose level its weight
   reaches. A register keeps the earliest time. Strips that two texts both fill give equal points,
   so registers agree with a probability equal to the similarity. A process stops as soon as its
   next point comes later than all registers.
3. Banding: texts that agree in all registers of a band share a bucket. Buckets are never expanded
   into all pairs. In each round every member is compared with a few pivots of its bucket that are
   not in its class yet. A pivot then leaves the bucket. The number of pivots grows eightfold until
   no bucket holds two classes, so there is no cap on a bucket's size. Members of one class are
   never compared to tell what is known, whatever their number; members of different classes
   of a bucket are, unless bounds exclude a link, so that none is lost. Bands take their pivots in
   four different orders, so a large group does not hang on one pivot. The strongest bound is what a
   text has to itself: shingles that no other text still in a bucket has are part of every union
   and of no overlap. Shingles are counted anew in each round and taken from the rarest on: a member
   leaves a bucket if no text of another class, of a size that fits, has a shingle as early in
   that order as a link needs. So most variants of one text that are alike and not linked go without
   being compared with each other. Those that stay are still compared with their buckets' pivots.
4. In each round pairs are first compared by their registers (one byte each), and those that could
   reach the threshold by the exact overlap of the whole multisets, so classes are exact at once.

Defined cases: texts without words (null, empty) are linked to nothing, not even to each other:
each row is its own class. Rows that share an id and a text are one document. A null id never is a
class id if its class has another.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import text as X
from strata.session import scratch_path

U = np.uint64
SHINGLE = 5
PART = 1 << 17  # words a worker looks at together; it holds some 20 arrays of that length
_EPS = 1e-6  # for bounds in doubles


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.8
    rows: int = 8
    bands: int = 30
    # Share of equal registers: with 240 of them one standard deviation is 0.026 at 0.8.
    maybe: float = 0.68
    slack: float = 0.12

    @property
    def registers(self) -> int:
        return self.rows * self.bands


def word_hashes(text: Column) -> Column:
    return F.transform(X.words(X.lower_ascii(X.filled(text))), lambda w: F.xxhash64(w))


# --- Signatures (numpy, inside tasks) -----------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingles(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle) for all shingles of texts laid end to end."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(len(hashes)) - starts
    # The last SHINGLE - 1 words start no shingle, but for the first word of a short text.
    own = (place + SHINGLE <= sizes[doc]) | ((place == 0) & (sizes[doc] < SHINGLE))
    first = np.flatnonzero(own)
    value = np.zeros(len(first), U)
    h = hashes.view(U)
    for k in range(SHINGLE):
        inside = place[first] + k < sizes[doc[first]]
        at = np.where(inside, first + k, 0)
        value = _mix(value * U(0x9E3779B97F4A7C15) + np.where(inside, h[at], U(k)))
    return doc[first], value


def weighted(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with how often it occurs, sorted by text."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    return doc[first], value[first], np.diff(np.append(first, len(doc)))


def signatures(doc, value, weight, texts: int, m: int) -> np.ndarray:
    """(texts, m) earliest times; infinite for a text without shingles."""
    times = np.full(texts * m, np.inf)
    # One process per strip: strip 0 is (0,1], strip k is (2^(k-1), 2^k].
    strips = np.ceil(np.log2(weight)).astype(np.int64) + 1
    row = np.repeat(np.arange(len(doc)), strips)
    strip = np.arange(len(row)) - np.repeat(np.cumsum(strips) - strips, strips)
    width = np.where(strip > 0, 1 << np.maximum(strip - 1, 0), 1)
    low = np.where(strip > 0, width, 0)
    text, reach = doc[row], weight[row]
    seed = _mix(value[row] + strip.astype(U) * U(0xD6E8FEB86659FD93))
    now, step, phase = np.zeros(len(row)), 0, np.zeros(1, U)
    while len(text):
        step, phase = step + 1, phase + U(0x9E3779B97F4A7C15)
        draw = _mix(seed + phase)
        now = now - np.log1p(-((draw >> U(11)).astype(float) * 2.0**-53)) / width
        other = _mix(draw ^ U(0xA0761D6478BD642F))
        level = low + (other >> U(32)).astype(np.int64) % width + 1
        taken = level <= reach
        register = text * m + (other % U(m)).astype(np.int64)
        np.minimum.at(times, register[taken], now[taken])
        # A process goes on while its text has a register that a later point could still lower.
        # Looking at all registers costs as much as many points, so it is not done at each step.
        if step < 4 or step % 4 == 0:
            last = times.reshape(texts, m).max(axis=1)
        going = now < last[text]
        text, reach, seed, now = text[going], reach[going], seed[going], now[going]
        width, low = width[going], low[going]
    return times.reshape(texts, m)


def sketch(hashes: np.ndarray, sizes: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each band, one byte of each register) per text."""
    times = signatures(*weighted(*shingles(hashes, sizes)), len(sizes), s.registers)
    bits = _mix(times.view(U) + np.arange(s.registers, dtype=U) * U(0x9E3779B97F4A7C15))
    banded = bits.reshape(len(sizes), s.bands, s.rows)
    bucket = np.zeros((len(sizes), s.bands), U)
    for k in range(s.rows):
        bucket = _mix(bucket + banded[:, :, k])
    return bucket, (bits >> U(56)).astype(np.uint8)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two texts given as word hashes."""
    sizes = np.array([len(a), len(b)])
    doc, value, weight = weighted(*shingles(np.concatenate([a, b]), sizes))
    left, right = doc == 0, doc == 1
    _, i, j = np.intersect1d(value[left], value[right], assume_unique=True, return_indices=True)
    shared = int(np.minimum(weight[left][i], weight[right][j]).sum())
    return shared / max(int(weight.sum()) - shared, 1)


def _parts(sizes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first text, one past the last, first word, one past the last) of at most ``PART`` words, or one text."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        done = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + PART, "right")))
        yield start, stop, done, int(ends[stop - 1])
        start = stop


def _lists(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    sizes = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return rows.flatten().to_numpy(zero_copy_only=False), sizes


def sketches(text: Column, s: Settings) -> Column:
    """Struct of ``buckets``, ``registers`` (binary) and ``size`` (shingles) of texts with words."""

    @F.arrow_udf("struct<buckets array<bigint>, registers binary, size int>")
    def compute(rows: pa.Array) -> pa.Array:
        flat, sizes = _lists(rows)
        buckets, registers = [], []
        for start, stop, low, high in _parts(sizes):
            one, two = sketch(flat[low:high], sizes[start:stop], s)
            buckets.append(one.view(np.int64).ravel())
            registers += [row.tobytes() for row in two]
        offsets = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * s.bands)
        values = pa.array(np.concatenate(buckets) if buckets else np.zeros(0, np.int64))
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(offsets, values),
                pa.array(registers, pa.binary()),
                pa.array(np.maximum(sizes - SHINGLE + 1, 1), pa.int32()),
            ],
            ["buckets", "registers", "size"],
        )

    return compute(word_hashes(text))


def _equal_share(left: pa.Array, right: pa.Array) -> np.ndarray:
    """The share of equal registers of each pair."""
    if not len(left):
        return np.zeros(0)
    a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(len(x), -1) for x in (left, right))
    return (a == b).mean(axis=1)


def _agreement(a: Column, b: Column) -> Column:
    @F.arrow_udf("double")
    def share(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array(_equal_share(left, right), pa.float64())

    # A filter on the share must not make Spark compute it twice; so with the overlap below.
    return share.asNondeterministic()(a, b)


def _overlap(a: Column, b: Column, ra: Column, rb: Column, s: Settings) -> Column:
    """The exact similarity of texts whose registers could reach the threshold, else null.

    Registers and words go to one function: two in a row would hold two workers a task.
    """
    maybe = s.maybe

    @F.arrow_udf("double")
    def exact(left: pa.Array, right: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        def arrays(rows: pa.Array) -> Iterator[np.ndarray]:
            flat, sizes = _lists(rows)
            ends = np.cumsum(sizes)
            return (flat[end - size : end] for end, size in zip(ends, sizes))

        pairs = zip(arrays(left), arrays(right), _equal_share(one, two) >= maybe)
        return pa.array([similarity(x, y) if alike else None for x, y, alike in pairs], pa.float64())

    return exact.asNondeterministic()(a, b, ra, rb)


def _weights(words: Column) -> Column:
    """The distinct shingles of a text with how often each occurs."""

    @F.arrow_udf("array<struct<shingle bigint, n int>>")
    def counted(rows: pa.Array) -> pa.Array:
        flat, sizes = _lists(rows)
        ends, values, counts = [np.zeros(1, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start, stop, low, high in _parts(sizes):
            doc, value, n = weighted(*shingles(flat[low:high], sizes[start:stop]))
            ends.append(ends[-1][-1] + np.searchsorted(doc, np.arange(stop - start), "right"))
            values.append(value.view(np.int64))
            counts.append(n)
        items = [pa.array(np.concatenate(values)), pa.array(np.concatenate(counts), pa.int32())]
        offsets = pa.array(np.concatenate(ends), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(items, ["shingle", "n"]))

    return counted(words)


# --- Plan ---------------------------------------------------------------------------------------


class _Stage:
    """Writes intermediate tables below one folder that all executors share."""

    def __init__(self, df: DataFrame):
        self.spark, self.folder = df.sparkSession, scratch_path(df.sparkSession, "minhash")
        self.count = 0

    def kept(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def _nodes(rows: DataFrame, s: Settings) -> DataFrame:
    """One row per distinct text with words: node, smallest id, buckets, registers."""
    some = rows.where(F.btrim(X.filled(F.col("text")), F.lit(X.SPACE)) != "")
    sketched = some.select("node", "id", sketches(F.col("text"), s).alias("s"))
    return sketched.groupBy("node").agg(
        F.min("id").alias("id"),
        F.any_value("s.buckets").alias("buckets"),
        F.any_value("s.registers").alias("registers"),
        F.any_value("s.size").alias("size"),
    )


def _compared(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (node, pivot) with the share of registers that agree."""
    a = nodes.select(F.col("node"), F.col("registers").alias("ra"))
    b = nodes.select(F.col("node").alias("pivot"), F.col("registers").alias("rb"))
    both = pairs.join(a, "node").join(b, "pivot")
    return both.select("node", "pivot", _agreement(F.col("ra"), F.col("rb")).alias("agree"))


def _with_class(rows: DataFrame, label: DataFrame, node: str, name: str) -> DataFrame:
    on = label.select(F.col("node").alias("of"), F.col("class").alias(name))
    joined = rows.join(on, F.col(node) == F.col("of"), "left").drop("of")
    return joined.withColumn(name, F.coalesce(name, node))


def classified(nodes: DataFrame, rows: DataFrame, stage: _Stage, s: Settings) -> DataFrame:
    """(node, class) of all nodes with a link."""
    spread = nodes.select("node", "size", F.posexplode("buckets").alias("band", "bucket"))
    members = spread.select(
        F.xxhash64("band", "bucket").alias("bucket"),
        F.struct(F.xxhash64("node", F.col("band") % 4).alias("o"), "node", "size").alias("member"),
    )
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("member").alias("m"))
    shared = sizes.where("n > 1").select(
        (F.col("bucket") + F.lit(0)).alias("of"), F.col("m.node").alias("pivot")
    )
    first = stage.kept(
        members.join(shared, F.col("bucket") == F.col("of"))
        .where(F.col("member.node") != F.col("pivot"))
        .select("bucket", "member", F.col("member.node").alias("node"), "pivot")
    )
    known = stage.kept(_compared(first.select("node", "pivot").distinct(), nodes))
    texts = stage.kept(_words_of(first, nodes, rows))
    alike = known.where(F.col("agree") >= s.maybe)
    links = stage.kept(_linked(alike.select("node", "pivot"), texts, s))
    label, done = components(links, stage), _ordered(known)
    # The first pivots have been compared with all of their buckets; the other members stay.
    rest = first.join(known, ["node", "pivot"]).select("bucket", "member", "node", "agree")
    rest = stage.kept(_open(_with_facts(rest, label.withColumn("own", F.lit(0))), s))
    pivots = 1
    while not rest.isEmpty():
        # The texts of members that are still in a bucket; each round has fewer.
        texts = _held(rest, texts, stage)
        facts = _hopeful(_with_class(texts, label, "node", "class"), stage, s)
        now = stage.kept(_open(rest.drop("class", "own").join(facts, "node"), s))
        pivots *= 8
        heads = stage.kept(_first(now, pivots))
        ahead = heads.select(
            F.col("bucket").alias("of"),
            F.col("node").alias("pivot"),
            F.col("class").alias("pivot_class"),
            F.col("agree").alias("pivot_agree"),
            F.col("size").alias("pivot_size"),
            F.col("own").alias("pivot_own"),
        )
        # One minus the similarity is a metric: two texts whose distances to the first pivot differ
        # by more than the threshold allows cannot be linked (the slack is over three deviations);
        # nor can two of which one has too few shingles, or too few that are not its own.
        apart = 1 - s.threshold + s.slack
        shared = F.least(F.col("member.size") - F.col("own"), F.col("pivot_size") - F.col("pivot_own"))
        differ = (
            (F.col("bucket") == F.col("of"))
            & (F.col("class") != F.col("pivot_class"))
            & (F.abs(F.col("agree") - F.col("pivot_agree")) <= apart)
            & (F.col("member.size") >= s.threshold * F.col("pivot_size"))
            & (F.col("pivot_size") >= s.threshold * F.col("member.size"))
            & (shared * (1 + s.threshold) >= s.threshold * (F.col("member.size") + F.col("pivot_size")) - _EPS)
        )
        # A pair that met in another bucket is not compared again.
        pairs = _ordered(now.join(ahead, differ)).distinct()
        pairs = stage.kept(pairs.join(done, ["node", "pivot"], "left_anti"))
        done = done.unionAll(pairs)
        links = stage.kept(_linked(pairs, texts, s))
        label = _merged(label, links, stage)
        # A pivot has now been compared with every member that is not in its class.
        rest = stage.kept(_open(now.join(heads, ["bucket", "node"], "left_anti"), s))
    return label


def _merged(label: DataFrame, links: DataFrame, stage: _Stage) -> DataFrame:
    """The classes after more links."""
    if links.isEmpty():
        return label
    ends = _with_class(_with_class(links, label, "node", "one"), label, "pivot", "two")
    ends = ends.select(F.col("one").alias("node"), F.col("two").alias("pivot"))
    above = components(ends.where("node != pivot"), stage)
    lifted = _with_class(label.withColumnRenamed("class", "was"), above, "was", "class")
    alone = above.join(label.select("node"), "node", "left_anti")
    return stage.kept(lifted.select("node", "class").unionAll(alone.select("node", "class")))


def _first(members: DataFrame, n: int) -> DataFrame:
    """The first ``n`` members of each bucket; Spark limits each group before the shuffle."""
    # Those most like the first pivot come first: they lie in the middle of a group of variants, so
    # more of the group is close to them than to one another.
    order = Window.partitionBy("bucket").orderBy(F.desc("agree"), "member")
    ranked = members.withColumn("place", F.row_number().over(order))
    return ranked.where(F.col("place") <= n).select("bucket", "node", "class", "agree", "own", "member.size")


def _held(members: DataFrame, texts: DataFrame, stage: _Stage) -> DataFrame:
    """The texts of members."""
    return stage.kept(texts.join(members.select("node").distinct(), "node", "left_semi"))


def _own(members: DataFrame, texts: DataFrame, stage: _Stage) -> DataFrame:
    """(node, own): how many shingles of each member, repeats counted, no other member has anywhere."""
    return _own_among(_held(members, texts, stage))


def _own_among(texts: DataFrame) -> DataFrame:
    """(node, own): how many shingles of each text, repeats counted, no other text has anywhere."""
    each = texts.select("node.a", "node.b", F.explode(_weights(F.col("words"))).alias("g"))
    # Sums by shingle start in each task, so a shingle that is everywhere moves little.
    counted = each.groupBy("g.shingle").agg(
        F.count(F.lit(1)).alias("texts"), F.min("a").alias("a"), F.min("b").alias("b"), F.sum("g.n").alias("n")
    )
    own = counted.where("texts = 1").groupBy("a", "b").agg(F.sum("n").alias("own"))
    same = (F.col("node.a") == F.col("a")) & (F.col("node.b") == F.col("b"))
    return texts.select("node").join(own, same, "left").select("node", F.coalesce("own", F.lit(0)).alias("own"))


def _hopeful(texts: DataFrame, stage: _Stage, s: Settings) -> DataFrame:
    """(node, class, own) of the texts that another one, not of their class, could be linked to.

    Shingles are put in one order, rare ones first; what a text has ``left`` at a shingle is its
    number of shingles from there on. A link of x and y has a first common shingle, and shares at
    most what either has left there, so both have left at least t / (1 + t) (size of x + size of y).
    The smaller one thus has left 2 t / (1 + t) of its size, and what the larger one has left bounds
    the sizes of the smaller. Texts are only counted by shingle and size, never paired.
    """
    each = texts.select("node.a", "node.b", F.explode(_weights(F.col("words"))).alias("g"))
    spread = each.groupBy(F.col("g.shingle").alias("of")).agg(F.count(F.lit(1)).alias("texts"))
    met = each.join(spread.where("texts > 1"), F.col("g.shingle") == F.col("of"))
    met = met.select("a", "b", "of", "texts", F.col("g.n").alias("n"))
    whole = Window.partitionBy("a", "b")
    onward = whole.orderBy(F.desc("texts"), "of").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = met.select("a", "b", "of", F.sum("n").over(onward).alias("left"), F.sum("n").over(whole).alias("known"))
    size = F.greatest(F.size("words") - (SHINGLE - 1), F.lit(1)).alias("size")
    named = texts.select(F.col("node.a").alias("na"), F.col("node.b").alias("nb"), "class", size)
    firsts = met.join(named, (F.col("a") == F.col("na")) & (F.col("b") == F.col("nb")))
    firsts = firsts.where(F.col("left") >= s.threshold * F.col("size") - _EPS)
    # A link has both sizes in one bin of the smaller one; bins are narrow, so few others are in it.
    part, bin_of = s.threshold / (1 + s.threshold), lambda n: F.floor(F.log(n.cast("double")) * 100)
    low = F.greatest(F.ceil(s.threshold * F.col("size") - _EPS), F.lit(1))
    high = F.least("size", F.floor(F.col("left") / part - F.col("size") + _EPS))
    firsts = stage.kept(
        firsts.select(
            F.struct("a", "b").alias("node"),
            "class",
            (F.col("size") - F.col("known")).alias("own"),
            "of",
            F.when(F.col("left") >= 2 * part * F.col("size") - _EPS, bin_of(F.col("size"))).alias("bin"),
            F.when(low <= high, bin_of(low)).alias("low"),
            F.when(low <= high, bin_of(high)).alias("high"),
        )
    )
    smaller, larger = firsts.where("bin IS NOT NULL"), firsts.where("low IS NOT NULL")
    kinds = F.min("class").alias("one"), F.max("class").alias("two")
    below = smaller.groupBy(F.col("of").alias("at"), F.col("bin").alias("b")).agg(*kinds)
    above = larger.groupBy(F.col("of").alias("at"), F.col("low").alias("l"), F.col("high").alias("h")).agg(*kinds)
    other = (F.col("of") == F.col("at")) & ((F.col("one") != F.col("class")) | (F.col("two") != F.col("class")))
    hopeful = larger.join(below, other & F.col("b").between(F.col("low"), F.col("high")), "left_semi").unionAll(
        smaller.join(above, other & F.col("bin").between(F.col("l"), F.col("h")), "left_semi")
    )
    return stage.kept(hopeful.select("node", "class", "own").distinct())


def _with_facts(members: DataFrame, facts: DataFrame) -> DataFrame:
    """``members`` with the class and the own shingles of their nodes."""
    on = facts.select(F.col("node").alias("of"), "class", "own")
    joined = members.join(on, F.col("node") == F.col("of"), "left").drop("of")
    return joined.withColumns({"class": F.coalesce("class", "node"), "own": F.coalesce("own", F.lit(0))})


def _open(members: DataFrame, s: Settings) -> DataFrame:
    """The members that some other one of their bucket, not of their class, could still be linked to.

    Buckets of one class have no pair left to look at. A link of x and y shares at most what is not
    x's own, and its union holds all of x and what is y's own.
    """
    kinds = members.groupBy(F.col("bucket").alias("of")).agg(
        F.min("class").alias("low"), F.max("class").alias("high"), F.min("own").alias("least")
    )
    joined = members.join(kinds.where("low != high"), F.col("bucket") == F.col("of"))
    size, own = F.col("member.size"), F.col("own")
    hopeful = joined.where(size - own >= s.threshold * (size + F.col("least")) - _EPS)
    return hopeful.drop("of", "low", "high", "least")


def _words_of(first: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Word hashes and registers of every node that shares a bucket. Only their texts are moved."""
    names = first.select("node").union(first.select(F.col("pivot").alias("node"))).distinct()
    wanted = names.join(nodes.select("node", "id", "registers"), "node").select(
        F.col("node").alias("of"), F.col("id").alias("of_id"), "registers"
    )
    one = (F.col("node") == F.col("of")) & F.col("id").eqNullSafe(F.col("of_id"))
    moved = rows.join(wanted, one).dropDuplicates(["node"])
    return moved.select("node", word_hashes(F.col("text")).alias("words"), "registers")


def _linked(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose exact similarity reaches the threshold.

    A pair's registers come with its words, so both sides are fetched once.
    """
    a = texts.select("node", F.col("words").alias("a"), F.col("registers").alias("ra"))
    b = texts.select(F.col("node").alias("pivot"), F.col("words").alias("b"), F.col("registers").alias("rb"))
    both = pairs.join(a, "node").join(b, "pivot")
    overlap = _overlap(F.col("a"), F.col("b"), F.col("ra"), F.col("rb"), s)
    exact = both.select("node", "pivot", overlap.alias("similarity"))
    return exact.where(F.col("similarity") >= s.threshold)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.least("node", "pivot").alias("node"), F.greatest("node", "pivot").alias("pivot")
    )


def components(edges: DataFrame, stage: _Stage) -> DataFrame:
    """(node, class) for all nodes of the edges.

    Each round hangs every node on its smallest neighbour, if that is smaller, and goes on with the
    edges between what is left. Node names are hashes, so their order is random and the graph
    shrinks by a constant factor; stars around pivots are done in one or two rounds.
    """
    edges = stage.kept(edges.select("node", F.col("pivot").alias("other")).distinct())
    label = None
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
        least = both.groupBy("node").agg(F.min("other").alias("m"))
        up = stage.kept(least.select("node", F.least("node", "m").alias("class")))
        if label is None:
            label = up
        else:
            on = up.select(F.col("node").alias("at"), F.col("class").alias("up"))
            label = stage.kept(
                label.join(on, F.col("class") == F.col("at"), "left").select(
                    "node", F.coalesce("up", "class").alias("class")
                )
            )
        u = up.select(F.col("node"), F.col("class").alias("cu"))
        v = up.select(F.col("node").alias("other"), F.col("class").alias("cv"))
        moved = edges.join(u, "node").join(v, "other").where(F.col("cu") != F.col("cv"))
        edges = stage.kept(
            moved.select(F.least("cu", "cv").alias("node"), F.greatest("cu", "cv").alias("other")).distinct()
        )
    if label is None:
        return edges.select("node", F.col("other").alias("class"))
    return label


def classes(docs: DataFrame, s: Settings = Settings(), doc_id: str = "doc_id", text: str = "text"):
    """One row per distinct text with words: ``node`` (its print), ``id`` (the smallest id that has
    it), ``class`` (the smallest print of its class) and ``class_id``."""
    rows = docs.select(
        X.fingerprint(F.col(text)).alias("node"), F.col(doc_id).alias("id"), F.col(text).alias("text")
    )
    stage = _Stage(docs)
    nodes = stage.kept(_nodes(rows, s))
    label = classified(nodes, rows, stage, s)
    named = nodes.select("node", "id").join(
        label.select(F.col("node").alias("of"), "class"), F.col("node") == F.col("of"), "left"
    )
    named = named.select("node", "id", F.coalesce("class", "node").alias("class"))
    ids = named.groupBy("class").agg(F.min("id").alias("class_id"))
    ids = ids.select(F.col("class.a").alias("a"), F.col("class.b").alias("b"), "class_id")
    same = (F.col("class.a") == F.col("a")) & (F.col("class.b") == F.col("b"))
    return named.join(ids, same).select("node", "id", "class", "class_id")


def near_duplicates(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Per row: ``doc_id``, ``copy_of`` (smallest id with the same text) and ``class_id``."""
    known = classes(docs, s)
    rows = docs.select("doc_id", X.fingerprint(F.col("text")).alias("print"))
    same = (F.col("print.a") == F.col("node.a")) & (F.col("print.b") == F.col("node.b"))
    return rows.join(known, same, "left").select(
        "doc_id",
        F.coalesce("id", "doc_id").alias("copy_of"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
    )
