"""Dimensions with a default member and deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import expressions as X
from strata.operators.keys import dense_key
from strata.sources import tables
from strata.specs import Calendar, Lookup


def default_member(
    schema: T.StructType, surrogate_key: str, natural_key: str, description: str, text: str
) -> tuple:
    """The member that unknown and missing references point to: both keys 0, the rest NULL."""
    given = {surrogate_key: 0, natural_key: 0, description: text}
    return tuple(given.get(field.name) for field in schema)


def require_keys(rows: DataFrame, natural_key: str) -> int:
    """The number of rows; raises unless the natural key is unique, never NULL, and never 0.

    A repeated key would multiply the fact's rows, and 0 is the default member's.
    """
    counted = rows.agg(
        F.count("*").alias("rows"),
        F.count_distinct(natural_key).alias("keys"),
        F.count_if(F.col(natural_key).isNull()).alias("nulls"),
        F.count_if(F.col(natural_key) == 0).alias("zeros"),
    ).first()
    if counted.nulls or counted.zeros or counted["rows"] != counted["keys"]:
        raise ValueError(f"{natural_key} is not a key: {counted.asDict()}")
    return counted["rows"]


def dimension(
    members: DataFrame,
    natural_key: str,
    surrogate_key: str,
    description: str,
    text: str,
    checked_rows: int | None = None,
) -> DataFrame:
    """Number the members by their natural key and add the default member.

    The key is checked first; ``checked_rows`` is the result of a ``require_keys`` already made.
    """
    known = require_keys(members, natural_key) if checked_rows is None else checked_rows
    keyed = dense_key(members, natural_key, surrogate_key, known)
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in keyed.schema])
    row = default_member(nullable, surrogate_key, natural_key, description, text)
    return tables.inline_rows(members.sparkSession, [row], nullable).unionByName(keyed)


def lookup_dimension(spark: SparkSession, lookup: Lookup, text: str) -> DataFrame:
    """A dimension from a short static lookup; its rows are at hand, so they are numbered here."""
    schema = T.StructType(
        [
            T.StructField(lookup.surrogate_key, T.LongType()),
            T.StructField(lookup.natural_key, T.IntegerType()),
            T.StructField(lookup.description, T.StringType()),
        ]
    )
    if len({key for key, _ in lookup.rows}) < len(lookup.rows):
        raise ValueError(f"{lookup.name} has duplicate keys")
    unknown = default_member(
        schema, lookup.surrogate_key, lookup.natural_key, lookup.description, text
    )
    members = [(place, *row) for place, row in enumerate(sorted(lookup.rows), start=1)]
    return tables.inline_rows(spark, [unknown, *members], schema)


def days(spark: SparkSession, calendar: Calendar) -> DataFrame:
    """One row ``full_date`` per day."""
    span = F.sequence(F.lit(calendar.first), F.lit(calendar.last), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(span).alias("full_date"))


def days_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row ``full_date`` per day of the range that a one-row frame gives."""
    span = F.sequence(F.to_date(first), F.to_date(last), F.expr("INTERVAL 1 DAY"))
    return bounds.select(F.explode(span).alias("full_date"))


def date_dimension(day_rows: DataFrame) -> DataFrame:
    """Calendar attributes of ``full_date``; the key is the int ``yyyyMMdd``."""
    day = F.col("full_date")
    return day_rows.select(
        X.date_key(day).alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        X.iso_weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        X.is_weekend(day).alias("is_weekend"),
    )


def key_sample(dim: DataFrame, natural_key: str, surrogate_key: str, n: int = 10) -> DataFrame:
    """The first ``n`` pairs of natural and surrogate key."""
    return dim.select(natural_key, surrogate_key).orderBy(natural_key).limit(n)
