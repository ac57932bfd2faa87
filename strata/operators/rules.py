"""Data-quality rules: flags, failure codes, and the split into clean and quarantined rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.specs import Column as Spec
from strata.specs import Rule

FAILURES = "validation_failures"


def cast_rules(columns: Sequence[Spec]) -> tuple[Rule, ...]:
    """One rule per cast column: its value was not lost in the cast.

    They need the flags of ``normalize(..., track_casts=True)``. Without them a number out of range would
    pass as a NULL that was read.
    """
    return tuple(Rule(f"{c.name}_cast", (), f"NOT `{c.lost}`") for c in columns if c.cast)


def without_flags(df: DataFrame, columns: Sequence[Spec]) -> DataFrame:
    """Drop the flags of the cast rules, which are never stored."""
    return df.drop(*[c.lost for c in columns])


def valid(rules: Sequence[Rule]) -> Column:
    """The row passes every rule."""
    return F.expr(" AND ".join(f"({rule.passes})" for rule in rules) or "true")


def failure_codes(rules: Sequence[Rule]) -> Column:
    """The codes of the failed rules, in rule order; an empty array for a clean row."""
    codes = [f"CASE WHEN NOT ({rule.passes}) THEN '{rule.code}' END" for rule in rules]
    return F.expr(f"array_compact(array({', '.join(codes)}))")


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add one flag per rule, the failure codes, and ``is_valid``."""
    flags = {rule.flag: F.expr(rule.passes) for rule in rules}
    return df.withColumns({**flags, FAILURES: failure_codes(rules), "is_valid": valid(rules)})


def clean(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that pass every rule.

    The condition is a plain conjunction over the columns, so it reaches the Parquet scan and no
    failure array is built for the (usual) good row.
    """
    return df.where(valid(rules))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that fail a rule, with their failure codes."""
    return df.where(~valid(rules)).withColumn(FAILURES, failure_codes(rules))


def rule_counts(rejected: DataFrame) -> DataFrame:
    """Failures per rule code; a row counts once for every rule it fails."""
    codes = rejected.select(F.explode(FAILURES).alias("rule"))
    return codes.groupBy("rule").agg(F.count("*").alias("failures"))


def rule_map(counts: DataFrame) -> DataFrame:
    """The counts as one map value (at most one entry per rule)."""
    entries = F.array_sort(F.collect_list(F.struct("rule", "failures")))
    return counts.agg(F.map_from_entries(entries).alias("rules_failed"))
