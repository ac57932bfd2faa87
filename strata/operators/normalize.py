"""Raw rows to silver columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import expressions as X
from strata.sources.lookups import lost_cast, select_list
from strata.specs import Column


def normalize(
    raw: DataFrame,
    columns: Sequence[Column],
    start: str,
    end: str,
    duration: str,
    loaded_at: str,
    load_time: SparkColumn | None = None,
    track_casts: bool = False,
) -> DataFrame:
    """Select, rename and cast; add the duration in minutes and the load time.

    ``load_time`` defaults to the time of the query; pass a literal for a repeatable result.
    A value that its type cannot hold becomes NULL. ``track_casts`` adds a flag per cast column that
    tells such a NULL from one that was read, for the rules of ``rules.cast_rules``.
    """
    flags = [f"{lost_cast(c)} AS `{c.lost}`" for c in columns if c.cast] if track_casts else []
    return raw.selectExpr(*select_list(columns), *flags).withColumns(
        {
            duration: X.minutes_between(start, end),
            loaded_at: F.current_timestamp() if load_time is None else load_time,
        }
    )


def with_month(df: DataFrame, ts: str) -> DataFrame:
    """Add the table partition columns ``year`` and ``month`` of an event time."""
    return df.withColumns({"year": F.year(ts), "month": F.month(ts)})
