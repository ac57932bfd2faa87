"""Pre-aggregated marts from one table of mergeable parts.

The fact is grouped once, by its integer slot keys, into counts and (sum, count) pairs (``totals``). Every
mart is a regrouping of these parts, so the big scan is made once for all of them, and a load that
touches some days needs the parts of those days alone. Dimension columns are joined to the groups last.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import trips
from strata.functions import totals as S
from strata.operators.fact import Dimension
from strata.operators.joins import lookup_join

ROWS = "row_count"


def parts(
    rows: DataFrame, keys: Sequence[str], measures: Sequence[str], scale: int | None = None
) -> DataFrame:
    """One row per key: the number of rows, and the mergeable parts of every measure."""
    pairs = [part for name in measures for part in S.parts(name, scale)]
    return rows.groupBy(*keys).agg(F.count("*").alias(ROWS), *pairs)


def regroup(
    parted: DataFrame, keys: Sequence[str], sums: Mapping[str, str], means: Mapping[str, str], rows: str
) -> DataFrame:
    """Parts of fine keys as sums and means of coarser ones; ``sums`` and ``means`` map measure to name."""
    return parted.groupBy(*keys).agg(
        F.sum(ROWS).alias(rows),
        *(F.sum(f"{m}__sum").cast("double").alias(name) for m, name in sums.items()),
        *(S.merged_mean(m).alias(name) for m, name in means.items()),
    )


def _zones(zones: Dimension, key: str) -> DataFrame:
    return zones.rows.select(F.col(zones.surrogate_key).alias(key), "zone_name", "borough")


def _dates(dates: Dimension, key: str, *columns: str) -> DataFrame:
    return dates.rows.select(F.col(dates.surrogate_key).alias(key), *columns)


def slot_parts(fact: DataFrame, scale: int | None = None) -> DataFrame:
    """The parts both marts are made of: one row per day, hour and pickup zone."""
    return parts(fact, trips.SLOT_KEYS, trips.SLOT_MEASURES, scale)


def daily_from_parts(slots: DataFrame, zones: Dimension, dates: Dimension) -> DataFrame:
    """Trips, revenue, tips and means per day and pickup zone."""
    grouped = regroup(
        slots, trips.DAILY_KEYS, trips.DAILY_SUMS, trips.DAILY_MEANS, "total_trips"
    )
    rows = lookup_join(
        grouped, _zones(zones, "pickup_zone_sk"), "pickup_zone_sk", "inner", zones.known_rows
    )
    day = _dates(dates, "pickup_date_sk", "full_date", "year", "month", "day_of_week")
    joined = lookup_join(rows, day, "pickup_date_sk", "inner", dates.known_rows)
    return joined.select(*trips.DAILY_COLUMNS)


def hourly_from_parts(
    slots: DataFrame, zones: Dimension, dates: Dimension, scale: int | None = None
) -> DataFrame:
    """Mean trips and mean of mean fares per weekday, hour and pickup zone.

    A slot without trips has no row, so it does not lower the mean.
    """
    day = _dates(dates, "pickup_date_sk", "day_of_week")
    slots = lookup_join(slots, day, "pickup_date_sk", "inner", dates.known_rows)
    slots = slots.withColumn("_slot_fare", S.parts_mean("fare_amount"))
    grouped = slots.groupBy("day_of_week", "pickup_hour", "pickup_zone_sk").agg(
        F.avg(ROWS).alias("avg_trips"), S.mean(F.col("_slot_fare"), scale).alias("avg_fare")
    )
    joined = lookup_join(
        grouped, _zones(zones, "pickup_zone_sk"), "pickup_zone_sk", "inner", zones.known_rows
    )
    return joined.select(*trips.HOURLY_COLUMNS)


def daily_metrics(
    fact: DataFrame, zones: Dimension, dates: Dimension, scale: int | None = None
) -> DataFrame:
    return daily_from_parts(slot_parts(fact, scale), zones, dates)


def hourly_patterns(
    fact: DataFrame, zones: Dimension, dates: Dimension, scale: int | None = None
) -> DataFrame:
    fares = parts(fact, trips.SLOT_KEYS, ("fare_amount",), scale)
    return hourly_from_parts(fares, zones, dates, scale)
