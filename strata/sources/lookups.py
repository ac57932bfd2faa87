"""Lookup files and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sources import tables
from strata.specs import Column


def read_csv(spark: SparkSession, path: str, columns: Sequence[Column]) -> DataFrame:
    """A CSV file with a header, all strings, then renamed and cast; a bad value becomes NULL."""
    raw = spark.read.option("header", "true").csv(path)
    return raw.selectExpr(*select_list(columns))


def select_list(columns: Sequence[Column]) -> list[str]:
    """The columns as SQL select expressions."""
    return [
        (f"try_cast(`{c.source}` AS {c.cast})" if c.cast else f"`{c.source}`") + f" AS `{c.name}`"
        for c in columns
    ]


def lost_cast(c: Column) -> str:
    """SQL text of "the source has a value and its cast has none"; never NULL."""
    return f"(`{c.source}` IS NOT NULL AND try_cast(`{c.source}` AS {c.cast}) IS NULL)"


def first_available(
    spark: SparkSession, path: str, table: str, columns: Sequence[Column]
) -> tuple[DataFrame | None, str | None]:
    """The lookup from the CSV if it can be read, else from the table, else ``(None, None)``."""
    try:
        return read_csv(spark, path, columns), path
    except AnalysisException:
        if not tables.exists(spark, table):
            return None, None
    return tables.read(spark, table).selectExpr(*select_list(columns)), table


def skipped(spark: SparkSession, check: str, path: str, table: str) -> DataFrame:
    """The one-row report of a check that found no lookup."""
    schema = T.StructType(
        [T.StructField("check", T.StringType()), T.StructField("message", T.StringType())]
    )
    return tables.inline_rows(spark, [(check, f"no lookup at {path} or {table}")], schema)
