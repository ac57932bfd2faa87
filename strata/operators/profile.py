"""Profiling of a raw table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.functions import totals as S
from strata.operators.checks import report
from strata.operators.joins import lookup_join
from strata.session import scratch_path
from strata.sources import tables

PERCENTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}
# Size of a quantile sketch: about 0.3 % of rank error, some 10 KB a sketch however many values.
SKETCH_K = 1000
# Log2 of the registers of a distinct-count sketch: about 0.8 % of error (one standard deviation).
SKETCH_BITS = 14


def null_rates(df: DataFrame) -> DataFrame:
    """NULL count and percentage of every column, in one pass, worst first."""
    measured = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    pct = lambda c: F.coalesce(F.try_divide(F.col(f"`{c}`") * 100.0, F.col("_rows")), F.lit(0.0))
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"`{c}`").alias("null_count"),
            pct(c).cast("double").alias("null_pct"),
        )
        for c in df.columns
    ]
    return report(measured, rows).orderBy(F.desc("null_pct"), "column_name")


def numeric_profile(
    df: DataFrame,
    value: str,
    too_low: Column,
    too_high: Column,
    scale: int | None = None,
    quantiles: str = "sketch",
) -> DataFrame:
    """Bounds, mean, percentiles and the number of values outside the plausible range.

    ``quantiles="sketch"`` takes the percentiles from a KLL sketch, in one pass with the rest. ``"exact"`` counts
    each value and takes all measures from the counts. The choice is the caller's, whatever the size;
    ``too_low`` and ``too_high`` may refer to ``value`` alone.
    """
    c = F.col(value)
    if quantiles == "exact":
        counts = df.groupBy(value).agg(F.count("*").alias("_n"), F.sum(S.addend(c, scale)).alias("_sum"))
        counts = tables.overwrite(counts, scratch_path(df.sparkSession, "value-counts"))
        weight, total = F.col("_n"), F.sum("_sum").cast("double")
        points = _ranked(counts, value)
    elif quantiles == "sketch":
        counts, weight, total, points = df, F.lit(1).cast("bigint"), S.total(c, scale), None
    else:
        raise ValueError(f"quantiles is 'exact' or 'sketch', not {quantiles!r}")

    def rows_where(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, weight)), F.lit(0))

    sketch = F.kll_sketch_agg_double(c.cast("double"), SKETCH_K)
    measured = counts.agg(
        F.min(c).alias("min_value"),
        F.max(c).alias("max_value"),
        F.try_divide(total, rows_where(c.isNotNull())).alias("mean_value"),
        rows_where(too_low).alias("too_low"),
        rows_where(too_high).alias("too_high"),
        *([sketch.alias("_sketch")] if points is None else []),
    )
    if points is None:
        measured = measured.withColumns(_quantiles_of("_sketch")).drop("_sketch")
    else:
        # Two frames of one row, and the values of one are NULL in the other.
        both = measured.unionByName(points, allowMissingColumns=True)
        measured = both.agg(*(F.max(name).alias(name) for name in both.columns))
    return measured.select(
        F.lit(value).alias("column_name"),
        "min_value",
        "max_value",
        "mean_value",
        *(f"{p}_value" for p in PERCENTILES),
        "too_low",
        "too_high",
    )


def _quantiles_of(sketch: str) -> dict[str, Column]:
    """Column per percentile of a sketch column; NULL for a sketch of no values."""
    some = F.kll_sketch_get_n_double(sketch) > 0
    return {
        f"{name}_value": F.when(some, F.kll_sketch_get_quantile_double(sketch, F.lit(p)))
        for name, p in PERCENTILES.items()
    }


def _ranked(counts: DataFrame, value: str) -> DataFrame:
    """One row: the value at the rank ``ceil(p * n)`` for every percentile, from stored counts per value.

    The values are dealt into ranges; a running total over the ranges (one row each) tells which of
    them hold a wanted rank, and only those, at most one a percentile, are ranked value by value.
    """
    known = counts.where(F.col(value).isNotNull()).select(F.col(value).alias("_v"), "_n")
    ranges = known.repartitionByRange("_v").withColumn("_range", F.spark_partition_id())
    ranges = tables.overwrite(ranges, scratch_path(counts.sparkSession, "value-ranges"))
    totals = ranges.groupBy("_range").agg(F.sum("_n").alias("_rows"))
    up_to, everything = Window.orderBy("_range"), Window.partitionBy()
    totals = totals.select(
        "_range", "_rows", F.sum("_rows").over(up_to).alias("_up_to"), F.sum("_rows").over(everything).alias("_all")
    )
    ranks = [
        F.struct(F.lit(name).alias("name"), F.ceil(F.col("_all") * p).alias("rank")) for name, p in PERCENTILES.items()
    ]
    before = F.col("_up_to") - F.col("_rows")
    wanted = totals.select("_range", before.alias("_before"), "_up_to", F.inline(F.array(*ranks))).where(
        (F.col("rank") > F.col("_before")) & (F.col("rank") <= F.col("_up_to"))
    )
    place = F.sum("_n").over(Window.partitionBy("name").orderBy("_v")) + F.col("_before")
    hit = ranges.join(F.broadcast(wanted), "_range").withColumn("_place", place)
    hit = hit.where((F.col("rank") <= F.col("_place")) & (F.col("rank") > F.col("_place") - F.col("_n")))
    return hit.agg(*(F.max(F.when(F.col("name") == p, F.col("_v"))).alias(f"{p}_value") for p in PERCENTILES))


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """One KLL sketch per group (a month, say), to be stored and merged later; NULL and NaN are left out."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One row: the percentiles and the number of values of all the sketches together; no data is read."""
    merged = sketches.agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))
    return merged.select(
        F.kll_sketch_get_n_double("sketch").alias("value_count"),
        *(c.alias(name) for name, c in _quantiles_of("sketch").items()),
    )


def value_counts(df: DataFrame, value: str) -> DataFrame:
    return df.groupBy(value).agg(F.count("*").alias("row_count")).orderBy(value)


def order_violations(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows that end before or when they start."""
    return df.agg(F.count_if(F.col(end) <= F.col(start)).alias("end_not_after_start"))


def describe(df: DataFrame, columns: Sequence[str], scale: int | None = None) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum per column, as numbers."""
    measured = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("value_count"),
                S.mean(F.col(c), scale).alias("mean"),
                F.stddev_samp(c).alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return report(measured, [F.col(c) for c in columns])


def orphans(df: DataFrame, roles: Sequence[str], lookup: DataFrame, key: str) -> DataFrame:
    """The distinct ids per role column that the lookup does not know (a NULL id is unknown)."""
    known = lookup.select(F.col(key).cast("int").alias(key)).distinct()
    per_role = [
        lookup_join(
            df.select(F.col(role).cast("int").alias(key)).distinct(), known, key, "left_anti"
        ).withColumn("role", F.lit(role))
        for role in roles
    ]
    return reduce(DataFrame.unionByName, per_role)


def orphan_counts(unknown: DataFrame) -> DataFrame:
    return unknown.groupBy("role").agg(F.count("*").alias("orphan_ids"))


def duplicate_keys(df: DataFrame, candidates: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct keys and surplus rows per candidate key; a key with a NULL part counts too.

    All candidates are counted in one scan, exactly; ``key_sketches`` is the way to count estimates that add up.
    """
    measured = df.agg(
        F.count("*").alias("_rows"),
        *(F.count_distinct(F.struct(*keys)).alias(name) for name, keys in candidates.items()),
    )
    rows = [
        F.struct(
            F.lit(name).alias("candidate_key"),
            F.col("_rows").alias("total_rows"),
            F.col(name).alias("distinct_keys"),
            (F.col("_rows") - F.col(name)).alias("duplicate_rows"),
        )
        for name in candidates
    ]
    return report(measured, rows)


def key_sketches(
    df: DataFrame, candidates: Mapping[str, Sequence[str]], by: Sequence[str], bits: int = SKETCH_BITS
) -> DataFrame:
    """Per group, the rows and one HLL sketch per candidate key, to be stored and merged later."""
    return df.groupBy(*by).agg(
        F.count("*").alias("row_count"),
        *(F.hll_sketch_agg(F.xxhash64(*keys), bits).alias(f"{name}__keys") for name, keys in candidates.items()),
    )


def merged_key_counts(sketches: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Estimated distinct keys per candidate over all groups; a key in two groups counts once."""
    merged = sketches.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("_rows"), *(F.hll_union_agg(f"{name}__keys").alias(name) for name in candidates)
    )
    rows = [
        F.struct(
            F.lit(name).alias("candidate_key"),
            F.col("_rows").alias("total_rows"),
            F.coalesce(F.hll_sketch_estimate(name), F.lit(0).cast("bigint")).alias("about_distinct"),
        )
        for name in candidates
    ]
    return report(merged, rows)
