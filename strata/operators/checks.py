"""Checks. Each returns rows ``check, expected, actual, passed, severity``; the caller decides.

Every check family is one aggregation over the table, however many columns or rules it covers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import expressions as X
from strata.functions import totals as S
from strata.operators.joins import lookup_join


def outcome(
    name: str | Column,
    expected: Column,
    actual: Column,
    passed: Column,
    severity: str = "error",
) -> Column:
    """One check row as a struct over the columns of an aggregated frame."""
    return F.struct(
        (F.lit(name) if isinstance(name, str) else name).alias("check"),
        expected.cast("string").alias("expected"),
        actual.cast("string").alias("actual"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        F.lit(severity).alias("severity"),
    )


def report(measured: DataFrame, outcomes: Sequence[Column]) -> DataFrame:
    """Turn a one-row frame of measurements into check rows."""
    return measured.select(F.inline(F.array(*outcomes)))


def failed(checks: DataFrame) -> DataFrame:
    """The failed checks that are not mere warnings."""
    return checks.where(~F.col("passed") & (F.col("severity") == "error"))


def require(checks: DataFrame) -> None:
    """Raise if a check failed."""
    bad = failed(checks).collect()
    if bad:
        raise AssertionError(
            "; ".join(f"{r.check}: expected {r.expected}, got {r.actual}" for r in bad)
        )


def row_counts(sides: Mapping[str, DataFrame | tuple[DataFrame, str]]) -> DataFrame:
    """One row with a count per side; a side given as (frame, column) adds up that column."""
    tagged = []
    for name, side in sides.items():
        rows, weight = side if isinstance(side, tuple) else (side, None)
        n = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
        tagged.append(rows.select(F.lit(name).alias("_side"), n.alias("_n")))
    both = reduce(DataFrame.unionByName, tagged)
    sums = [
        F.coalesce(F.sum(F.when(F.col("_side") == name, F.col("_n"))), F.lit(0)).alias(name)
        for name in sides
    ]
    return both.agg(*sums)


def same_count(name: str, expected: str, actual: str) -> Column:
    return outcome(name, F.col(expected), F.col(actual), F.col(expected) == F.col(actual))


def not_empty(name: str, side: str) -> Column:
    return outcome(name, F.lit("> 0"), F.col(side), F.col(side) > 0)


def at_most(name: str, bound: Column, actual: Column) -> Column:
    return outcome(name, F.concat(F.lit("<= "), bound.cast("string")), actual, actual <= bound)


def within_loss(name: str, larger: str, smaller: str, tolerance: int) -> Column:
    """``smaller`` may lack up to ``tolerance`` rows of ``larger`` and never has more."""
    lost = F.col(larger) - F.col(smaller)
    return outcome(name, F.lit(f"0..{tolerance}"), lost, lost.between(0, tolerance))


def null_checks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """No NULL in any of the columns, in one pass."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return report(
        nulls,
        [outcome(f"{c} is not null", F.lit(0), F.col(c), F.col(c) == 0) for c in columns],
    )


def schema_checks(
    df: DataFrame, types: Mapping[str, str], required: Sequence[str] = ()
) -> DataFrame:
    """Columns with a required type, and columns that only have to be there, with NULL counts.

    ``actual`` is the type found or ``missing``; ``nulls`` is counted over the whole table.
    """
    found = {field.name: field.dataType.simpleString() for field in df.schema}
    wanted = {**{c: None for c in required}, **types}
    counted = df.agg(
        *[
            (F.count_if(F.col(c).isNull()) if c in found else F.lit(None).cast("bigint")).alias(c)
            for c in wanted
        ]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(kind or "any type").alias("expected"),
            F.lit(found.get(c, "missing")).alias("actual"),
            F.lit(c in found and kind in (None, found.get(c))).alias("passed"),
            F.col(c).alias("nulls"),
        )
        for c, kind in wanted.items()
    ]
    return report(counted, rows)


def set_difference(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """The rows on one side only, labelled ``missing`` (expected, not there) or ``unexpected``."""
    columns = expected.columns
    sides = expected.select(*columns, F.lit(1).alias("_expected"), F.lit(0).alias("_actual"))
    sides = sides.unionByName(
        actual.select(*columns, F.lit(0).alias("_expected"), F.lit(1).alias("_actual"))
    )
    # Grouping takes NULLs as equal, needs one shuffle and keeps only distinct rows per task.
    grouped = sides.groupBy(*columns).agg(
        F.max("_expected").alias("_expected"), F.max("_actual").alias("_actual")
    )
    return grouped.where("_expected != _actual").select(
        *columns, F.when(F.col("_expected") == 1, "missing").otherwise("unexpected").alias("status")
    )


def out_of_range_share(
    df: DataFrame, name: str, ts: str, year: int, months: tuple[int, int]
) -> DataFrame:
    """Count and percentage of rows outside the expected months; a warning, never an error."""
    first, last = months
    inside = (F.year(ts) == year) & F.month(ts).between(first, last)
    measured = df.agg(F.count_if(~inside).alias("outside"), F.count("*").alias("total"))
    share = F.coalesce(F.try_divide(F.col("outside") * 100.0, F.col("total")), F.lit(0.0))
    row = outcome(name, F.lit(0), F.col("outside"), F.col("outside") == 0, severity="warn")
    return measured.select(
        F.inline(F.array(row)), share.cast("double").alias("pct"), F.col("total").alias("rows_seen")
    )


def key_checks(df: DataFrame, surrogate_key: str, natural_key: str) -> DataFrame:
    """The surrogate key is never NULL and unique; so is the natural key."""
    measured = df.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(surrogate_key).isNull()).alias("nulls"),
        F.count_distinct(F.struct(surrogate_key)).alias("surrogates"),
        F.count_distinct(F.struct(natural_key)).alias("naturals"),
    )
    return report(
        measured,
        [
            outcome(f"{surrogate_key} is not null", F.lit(0), F.col("nulls"), F.col("nulls") == 0),
            same_count(f"{surrogate_key} is unique", "rows", "surrogates"),
            same_count(f"{natural_key} is unique", "rows", "naturals"),
        ],
    )


def sum_checks(
    left: DataFrame,
    right: DataFrame,
    columns: Sequence[str],
    tolerance: float,
    scale: int | None = None,
) -> DataFrame:
    """The sums of both sides agree within ``tolerance``; an empty side counts as 0."""
    kinds = dict(left.dtypes)
    nothing = [F.lit(None).cast(kinds[c]).alias(f"_right_{c}") for c in columns]
    sides = left.select(*columns, *nothing).unionByName(
        right.select(
            *[F.lit(None).cast(kinds[c]).alias(c) for c in columns],
            *[F.col(c).alias(f"_right_{c}") for c in columns],
        )
    )
    sums = sides.agg(
        *[
            F.coalesce(S.total(F.col(c), scale), F.lit(0.0)).alias(c)
            for name in columns
            for c in (name, f"_right_{name}")
        ]
    )
    rows = [
        F.struct(
            F.lit(c).alias("measure"),
            F.col(c).alias("left_sum"),
            F.col(f"_right_{c}").alias("right_sum"),
            F.abs(F.col(c) - F.col(f"_right_{c}")).alias("difference"),
            (F.abs(F.col(c) - F.col(f"_right_{c}")) < tolerance).alias("passed"),
        )
        for c in columns
    ]
    return report(sums, rows)


def same_rows(name: str, first: DataFrame, second: DataFrame) -> DataFrame:
    """Two builds hold the same rows, each the same number of times."""
    columns = first.columns
    sides = first.withColumn("_n", F.lit(1)).unionByName(
        second.select(*columns).withColumn("_n", F.lit(-1))
    )
    differing = sides.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n != 0")
    measured = differing.agg(F.coalesce(F.sum(F.abs("_n")), F.lit(0)).alias("differing"))
    row = outcome(name, F.lit(0), F.col("differing"), F.col("differing") == 0)
    return report(measured, [row])


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: the rows and the sum of 60 bits of each row's MD5, for any order and layout of the rows.

    A multiset hash: equal tables have equal sums, a changed, lost or repeated row changes it, and
    nothing is shuffled but one partial sum per task. Not a defence against forged rows.
    """
    spelt = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(X.HASH_NULL)) for c in sorted(df.columns)]
    digest = F.md5(F.concat_ws(X.HASH_SEPARATOR, *spelt).cast("binary"))
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(number), F.lit(0)).alias("print"))


def same_fingerprint(name: str, first: DataFrame, second: DataFrame) -> DataFrame:
    """Two builds hold the same rows, by fingerprint; expected and actual are ``rows:print``."""
    sides = fingerprint(first).withColumn("side", F.lit(1)).unionByName(
        fingerprint(second.select(*first.columns)).withColumn("side", F.lit(2))
    )
    spelt = F.concat_ws(":", "rows", "print")
    both = sides.agg(*(F.max(F.when(F.col("side") == i, spelt)).alias(f"side_{i}") for i in (1, 2)))
    return report(both, [same_count(name, "side_1", "side_2")])


def measured(sides: Mapping[str, tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """One row with all measures of all tables; each table is read once, whatever is measured of it.

    ``sides`` maps a table's name to its rows and its aggregates by name. A measure is called by its
    own name, so names differ between tables.
    """
    names = [name for _, wanted in sides.values() for name in wanted]
    rows = [df.agg(*(c.alias(name) for name, c in wanted.items())) for df, wanted in sides.values()]
    # One row per table, and NULL for what another table measures.
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return both.agg(*(F.max(name).alias(name) for name in names))


def sample_lineage(
    silver: DataFrame,
    fact: DataFrame,
    zones: DataFrame,
    dates: DataFrame,
    window: Column,
    order_by: Sequence[str],
    n: int,
) -> DataFrame:
    """The first ``n`` silver rows of a window next to the fact rows they became.

    The ``n`` sample rows are broadcast; the fact is scanned once and never shuffled.
    """
    keys = ("pickup_datetime", "pickup_location_id", "dropoff_location_id", "fare_amount")
    sample = silver.where(window).orderBy(*order_by).limit(n)
    s, f = sample.alias("s"), fact.alias("f")
    match = X.all_of(F.col(f"s.{k}") == F.col(f"f.{k}") for k in keys)
    found = f.join(F.broadcast(s), match).select(
        "s.pickup_datetime",
        "s.dropoff_datetime",
        F.col("s.pickup_location_id").alias("silver_pickup_location_id"),
        F.col("f.pickup_zone_sk").alias("gold_pickup_zone_sk"),
        F.col("s.dropoff_location_id").alias("silver_dropoff_location_id"),
        F.col("f.dropoff_zone_sk").alias("gold_dropoff_zone_sk"),
        "s.fare_amount",
        "s.tip_amount",
        "s.total_amount",
        F.col("f.pickup_date_sk").alias("gold_pickup_date_sk"),
    )
    for key, label in (
        ("gold_pickup_zone_sk", "pickup_zone_name"),
        ("gold_dropoff_zone_sk", "dropoff_zone_name"),
    ):
        found = lookup_join(
            found,
            zones.select(F.col("zone_sk").alias(key), F.col("zone_name").alias(label)),
            key,
        )
    days = dates.select(
        F.col("date_sk").alias("gold_pickup_date_sk"), F.col("full_date").alias("gold_full_date")
    )
    return lookup_join(found, days, "gold_pickup_date_sk").select(
        "pickup_datetime",
        "dropoff_datetime",
        "silver_pickup_location_id",
        "gold_pickup_zone_sk",
        "pickup_zone_name",
        "silver_dropoff_location_id",
        "gold_dropoff_zone_sk",
        "dropoff_zone_name",
        "fare_amount",
        "tip_amount",
        "total_amount",
        "gold_pickup_date_sk",
        "gold_full_date",
    )
