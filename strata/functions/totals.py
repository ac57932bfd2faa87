"""Sums and means.

A sum of doubles depends in its last digits on the order in which tasks finish, so a retry can
change it. Where that matters, pass ``scale``: every value is then added as fixed point with that
many decimals, which gives the same total on every run and every cluster size. Without it the
plain double sum is used, which is faster.

A mean is always kept as a (sum, count) pair until the last step, so that a grouped frame can be
grouped again without losing the weights.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed-point values are decimal(28, scale); Spark widens the running sum to 38 digits.
DIGITS = 28


def addend(value: Column, scale: int | None) -> Column:
    return value if scale is None else value.cast(f"decimal({DIGITS},{scale})")


def total(value: Column, scale: int | None = None) -> Column:
    """Sum as double."""
    return F.sum(addend(value, scale)).cast("double")


def mean(value: Column, scale: int | None = None) -> Column:
    """Mean as double, NULL for no values."""
    if scale is None:
        return F.avg(value)
    return F.try_divide(total(value, scale), F.count(value))


def parts(name: str, scale: int | None = None, value: Column | None = None) -> list[Column]:
    """The mergeable parts of a sum or mean: ``name__sum`` and ``name__n``."""
    value = F.col(name) if value is None else value
    return [
        F.sum(addend(value, scale)).alias(f"{name}__sum"),
        F.count(value).alias(f"{name}__n"),
    ]


def merge_parts(name: str) -> list[Column]:
    """Re-aggregate the parts of one level into the parts of the next."""
    return [
        F.sum(f"{name}__sum").alias(f"{name}__sum"),
        F.sum(f"{name}__n").alias(f"{name}__n"),
    ]


def merged_mean(name: str) -> Column:
    """The mean from parts that are aggregated once more in the same step."""
    return F.try_divide(F.sum(f"{name}__sum").cast("double"), F.sum(f"{name}__n"))


def parts_sum(name: str) -> Column:
    return F.col(f"{name}__sum").cast("double")


def parts_mean(name: str) -> Column:
    return F.try_divide(parts_sum(name), F.col(f"{name}__n"))
