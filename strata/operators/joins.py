"""Joins of large rows with lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup of at most this many (narrow) rows is broadcast: some tens of MB per executor.
BROADCAST_ROWS = 500_000


def fits(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows.

    A plain count: it reads no column and adds up per task, where a limit would bring up to
    ``rows`` rows of every task into one.
    """
    return df.count() <= rows


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    known_rows: int | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join many rows with a lookup that has at most one row per key.

    The lookup is broadcast only when its size is known to be small: by ``known_rows``, or by
    counting it. Beyond the bound it is a shuffled join, where adaptive execution
    splits the partitions of a hot key.
    """
    small = known_rows <= max_rows if known_rows is not None else fits(lookup, max_rows)
    return rows.join(F.broadcast(lookup) if small else lookup, on, how)
