"""Benchmark decontamination by spaced seeds.

A seed is a mask over token positions: where it has a 1 the token counts, where it has a 0 any
token does. The hashes of all seeds of all items are joined with those of all texts; a hit fixes
an item, a text and how the two lie to each other. Each such alignment is then verified: somewhere
along it ``window`` neighbouring tokens (the whole item, if that is shorter) must agree in at
least ``agree`` of their places. So a passage is found though some of its words were replaced.

The masks follow from the length that is verified and the places that may differ in it, so that
every way to differ leaves one mask whole (``masks``). Only the masks that the items need are
laid over the texts.

Tokens are runs of letters and digits in lower case; in scripts without spaces each character is
a token.

Defined cases: null and empty texts and items have no tokens and never match. An item so
short that no place may differ is reported where all of it is found. Repeated items and rows give the same
pair once. A null id is carried as it is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import text as X

UNSPACED = "".join(
    rf"\p{{Is{script}}}" for script in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")
)
WINDOW = 13
AGREE = 0.8
# Seeds of items that one pass over the texts may broadcast (about 40 bytes each and the tokens).
MOST_SEEDS = 500_000


def tokens(text: Column) -> Column:
    """64-bit hashes of the tokens of a text."""
    apart = F.regexp_replace(F.lower(X.filled(text)), f"([{UNSPACED}])", " $1 ")
    parts = F.split(apart, r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def masks(length: int, agree: float) -> list[str]:
    """Masks of which one is whole wherever at least ``agree`` of ``length`` places agree.

    Of one block more than two to the places that may differ, two stay whole at least; with few
    ways to differ there is a mask for each, which keeps all other places.
    """
    differ = length - max(1, math.ceil(agree * length))
    if math.comb(length, differ) <= 5:
        kept = combinations(range(length), length - differ)
    else:
        size = max(1, length // (differ + 2))
        blocks = [range(k * size, (k + 1) * size) for k in range(min(differ + 2, length))]
        kept = ([*a, *b] for a, b in combinations(blocks, 2))
    shapes = {tuple(i - own[0] for i in own): None for own in kept}
    return ["".join("01"[i in own] for i in range(own[-1] + 1)) for own in shapes]


def masks_by_length(lengths: Sequence[int], agree: float) -> dict[str, list[int]]:
    """Each mask that is needed, with the lengths that need it."""
    needed: dict[str, list[int]] = {}
    for length in sorted(lengths):
        for mask in masks(length, agree):
            needed.setdefault(mask, []).append(length)
    return needed


def seeds(rows: DataFrame, column: str, needed: dict[str, list[int]], length: Column | None = None) -> DataFrame:
    """One row per mask and position where it fits: ``at`` and ``seed``, beside all columns.

    With ``length`` a row gets only the masks of its length. The masks are rows of places, so one
    short expression serves them all: a method that spells out each mask would be too long for the
    JVM to compile. Masks of less weight than others repeat their last place.
    """
    places = [[i for i, bit in enumerate(mask) if bit == "1"] for mask in needed]
    weight = max(len(own) for own in places)
    cells = [
        F.struct(
            F.lit(k).alias("mask"),
            F.lit(len(mask)).alias("span"),
            F.array(*map(F.lit, needed[mask])).alias("lengths"),
            *[F.lit(own[min(n, len(own) - 1)]).alias(f"p{n}") for n in range(weight)],
        )
        for k, (mask, own) in enumerate(zip(needed, places))
    ]
    masked = rows.withColumn("m", F.explode(F.array(*cells)))
    fits = F.size(column) >= F.col("m.span")
    if length is not None:
        fits = fits & F.array_contains("m.lengths", length)
    starts = F.sequence(F.lit(0), F.size(column) - F.col("m.span"))
    at = masked.where(fits).withColumn("at", F.explode(starts))
    picked = [F.get(column, F.col("at") + F.col(f"m.p{n}")) for n in range(weight)]
    return at.withColumn("seed", F.xxhash64("m.mask", *picked)).drop("m")


def _best(agrees: Column, window: Column) -> Column:
    """The most places that agree in any ``window`` neighbouring places."""
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"))

    def slide(all_):
        def add(state, i):
            left = F.when(i >= window, F.get(all_, i - window)).otherwise(0)
            now = state["now"] + F.get(all_, i) - left
            return F.struct(now.alias("now"), F.greatest(state["best"], now).alias("best"))

        places = F.sequence(F.lit(0), F.size(all_) - 1)
        return F.aggregate(places, zero, add, lambda state: state["best"])

    return X.let(agrees, slide)


def _block(
    docs: DataFrame, items: DataFrame, window: int, agree: float, needed: dict[str, list[int]]
) -> DataFrame:
    checked = F.least(F.lit(window), F.size("item_tokens"))
    known = seeds(items, "item_tokens", needed, checked).select(
        "seed", "item_id", F.col("at").alias("item_at"), F.size("item_tokens").alias("item_size")
    )
    hits = seeds(docs, "doc_tokens", needed).join(F.broadcast(known), "seed")
    shift = F.col("at") - F.col("item_at")
    first = F.greatest(F.lit(0), -shift)
    size = F.least(F.col("item_size"), F.size("doc_tokens") - shift) - first
    # The stretch of the text that lies along the item; alignments hit often are told once.
    aligned = hits.select(
        "doc_id",
        "item_id",
        "item_size",
        first.alias("first"),
        F.slice("doc_tokens", first + shift + 1, size).alias("stretch"),
    ).distinct()
    item = items.select(F.col("item_id").alias("own_id"), "item_tokens").distinct()
    same_item = F.col("item_id").eqNullSafe(F.col("own_id")) & (
        F.col("item_size") == F.size("item_tokens")
    )
    pairs = aligned.join(F.broadcast(item), same_item)
    part = F.slice("item_tokens", F.col("first") + 1, F.size("stretch"))
    equal = F.zip_with("stretch", part, lambda a, b: (a == b).cast("int"))
    length = F.least(F.lit(window), F.col("item_size"))
    checked = pairs.select(
        "doc_id", "item_id", length.alias("length"), _best(equal, length).alias("agreeing")
    )
    return checked.where(F.col("agreeing") >= agree * F.col("length"))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    agree: float = AGREE,
    most_seeds: int = MOST_SEEDS,
) -> DataFrame:
    """Pairs (doc_id, item_id) with ``agreeing`` of ``length`` places in the best window.

    The items are broadcast in blocks of a counted size; each block is one pass over the texts.
    """
    items = benchmark.select("item_id", tokens(F.col("text")).alias("item_tokens"))
    checked = F.least(F.lit(window), F.size("item_tokens")).alias("length")
    sizes = items.groupBy(checked).agg(F.sum(F.size("item_tokens")).alias("n")).where("length > 0").collect()
    # A row per length up to the window; with no items the masks of the window serve.
    needed = masks_by_length([row.length for row in sizes] or [window], agree)
    total = sum(row.n * len(masks(row.length, agree)) for row in sizes)
    blocks = -(-total // most_seeds) or 1
    rows = docs.select("doc_id", tokens(F.col("text")).alias("doc_tokens"))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = reduce(
        DataFrame.unionAll,
        [_block(rows, items.where(block == k), window, agree, needed) for k in range(blocks)],
    )
    return found.groupBy("doc_id", "item_id").agg(
        F.max("length").alias("length"), F.max("agreeing").alias("agreeing")
    )
