"""Small column helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACES = r"[\x20\x09-\x0D]+"


def filled(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for a null text."""
    trimmed = F.btrim(filled(text), F.lit(SPACE))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, _SPACES))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Catalyst may copy an expression to every place that refers to it, also into a lambda, where it
    would run once per element. The variable of a lambda is never copied.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fingerprint(text: Column) -> Column:
    """128 bits of a text as two longs; a null text is another one than the empty text."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b"))


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id spelt as text, modulo ``divisor``; a null id is spelt as the empty text."""
    return F.crc32(filled(doc_id.cast("string")).cast("binary")) % divisor


def labelled_sample(
    labels: DataFrame, label: str, fold: Column, most: int, only: int | None = None
) -> DataFrame:
    """At most ``most`` training rows (doc_id, label), so a size fit for a broadcast.

    ``fold`` says which rows may be learnt from. A document labelled twice counts as 1 only if
    all its labels are; ``only`` then keeps the documents of one label. Rows are taken by the hash of
    the id, so the choice is repeatable.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & fold)
    one = rows.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    if only is not None:
        one = one.where(F.col("label") == only)
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
