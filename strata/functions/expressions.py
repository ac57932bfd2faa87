"""Column expressions. All are built-in Spark functions and stay inside whole-stage codegen."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a NULL and the column border are spelt inside a row hash.
HASH_NULL = "∅"
HASH_SEPARATOR = "||"
# ISO weekday names, Monday first.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions)


def sql_literal(value) -> str:
    """A partition value as SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, dt.date):
        return f"DATE '{value}'"
    return str(value)


def seconds_between(start: str, end: str) -> Column:
    """Whole seconds from ``start`` to ``end`` (bigint)."""
    return F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))


def minutes_between(start: str, end: str) -> Column:
    return (seconds_between(start, end) / F.lit(60.0)).cast("double")


def date_key(day: Column) -> Column:
    """The int ``yyyyMMdd`` of a date or timestamp, by arithmetic rather than through a string."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def iso_weekday(day: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(day) + 1


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def weekday_name(number: Column) -> Column:
    """The name of an ISO weekday number; NULL for any other number."""
    return reduce(
        lambda chain, item: chain.when(number == item[0], item[1]),
        enumerate(WEEKDAYS, start=1),
        F,
    )


def positive_ratio(numerator: Column, divisor: Column) -> Column:
    """``numerator / divisor`` in double, NULL unless the divisor is positive."""
    return F.when(divisor > 0, numerator.cast("double") / divisor.cast("double"))


def content_hash(columns: Iterable[str]) -> Column:
    """SHA-256 over the string forms of the columns, taken in name order, NULLs spelt out."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(HASH_NULL)) for c in sorted(columns)]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)
