"""Gold: dimensions, fact, marts, and the checks between the layers."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import trips
from strata.functions import totals as S
from strata.operators import checks, marts
from strata.operators.dimensions import (
    date_dimension,
    days,
    dimension,
    lookup_dimension,
    require_keys,
)
from strata.operators.fact import Dimension, build_fact, within
from strata.sources import snapshots, tables
from strata.specs import Calendar

FACT_PARTITIONS = ("pickup_date_sk",)
# Digits of the fixed point in which money and measures are added up.
SCALE = 9
LOOKUPS = (trips.PAYMENT_TYPES, trips.RATE_CODES, trips.VENDORS)


@dataclass(frozen=True)
class GoldTables:
    """The folder (or database) the gold tables live in."""

    base: str

    def named(self, name: str) -> str:
        return f"{self.base}/{name}" if tables.is_path(self.base) else f"{self.base}.{name}"


def zone_dimension(zones: DataFrame, checked_rows: int | None = None) -> DataFrame:
    return dimension(zones, "location_id", "zone_sk", "zone_name", trips.NOT_PROVIDED, checked_rows)


def trip_dimensions(
    spark: SparkSession, zones: DataFrame, calendar: Calendar
) -> dict[str, Dimension]:
    """All five dimensions as frames; ``zones`` is the zone lookup."""
    # Checked and counted once, for the numbering and for every join.
    n_zones = require_keys(zones, "location_id")
    zone_rows = zone_dimension(zones, n_zones)
    date_rows = date_dimension(days(spark, calendar))
    built = {
        "dim_zones": Dimension(zone_rows, "location_id", "zone_sk", n_zones + 1),
        "dim_date": Dimension(date_rows, "full_date", "date_sk", calendar.days),
    }
    for lookup in LOOKUPS:
        rows = lookup_dimension(spark, lookup, trips.NOT_PROVIDED)
        built[lookup.name] = Dimension(
            rows, lookup.natural_key, lookup.surrogate_key, len(lookup.rows) + 1
        )
    return built


def write_dimensions(dims: Mapping[str, Dimension], gold: GoldTables) -> dict[str, Dimension]:
    """Write the dimensions; returns them as written."""
    return {
        name: Dimension(
            tables.overwrite(dim.rows, gold.named(name)),
            dim.natural_key,
            dim.surrogate_key,
            dim.known_rows,
        )
        for name, dim in dims.items()
    }


def dimension_checks(dims: Mapping[str, Dimension]) -> DataFrame:
    """Keys of every dimension, and the sizes that are known beforehand."""
    reports = []
    for name, dim in dims.items():
        keys = checks.key_checks(dim.rows, dim.surrogate_key, dim.natural_key)
        if dim.known_rows is not None:
            size = F.lit(dim.known_rows)
            counted = checks.row_counts({"rows": dim.rows})
            actual = F.col("rows")
            keys = keys.unionByName(
                checks.report(
                    counted, [checks.outcome("row count", size, actual, size == actual)]
                )
            )
        reports.append(keys.withColumn("check", F.concat(F.lit(f"{name}: "), "check")))
    result = reports[0]
    for more in reports[1:]:
        result = result.unionByName(more)
    return result


def rerun_checks(stored: Mapping[str, Dimension], again: Mapping[str, Dimension]) -> DataFrame:
    """Every dimension is the same on a rerun: keys, labels and number of rows."""
    return functools.reduce(
        DataFrame.unionByName,
        [
            checks.same_fingerprint(f"{name} is the same on a rerun", dim.rows, again[name].rows)
            for name, dim in stored.items()
        ],
    )


def write_fact(fact: DataFrame, gold: GoldTables) -> DataFrame:
    return tables.overwrite(fact, gold.named("fct_trips"), FACT_PARTITIONS)


def fact_checks(
    silver: DataFrame,
    fact: DataFrame,
    calendar: Calendar,
    max_loss: int = 100,
    scale: int | None = SCALE,
) -> DataFrame:
    """No fan-out, at most ``max_loss`` rows outside the calendar, no NULL key, equal sums.

    ``fact`` is the stored fact: it has as many rows as the plan that was written. One pass over it and
    one over silver's days; all of silver is only counted, which reads no column. Sums of doubles
    depend on the order of the rows, so they are added in fixed point.
    """
    amounts = ("fare_amount", "tip_amount", "total_amount")

    def sums(side: str) -> dict:
        return {f"{side}_{c}": F.coalesce(S.total(F.col(c), scale), F.lit(0.0)) for c in amounts}

    nulls = {f"null_{c}": F.count_if(F.col(c).isNull()) for c in trips.FACT_KEYS}
    inside = within(silver, trips.START, calendar)
    found = checks.measured(
        {
            "silver": (silver, {"silver": F.count("*")}),
            "inside": (inside, {"inside": F.count("*"), **sums("silver")}),
            "fact": (fact, {"fact": F.count("*"), **nulls, **sums("fact")}),
        }
    )
    tolerance = 0.01

    def equal(c: str):
        left, right = F.col(f"silver_{c}"), F.col(f"fact_{c}")
        spelt = [side.cast("decimal(38,2)") for side in (left, right)]
        return checks.outcome(f"sum of {c}", *spelt, F.abs(left - right) < tolerance)

    return checks.report(
        found,
        [
            checks.within_loss("rows lost at the calendar edge", "silver", "fact", max_loss),
            checks.same_count("fact as computed", "inside", "fact"),
            *(
                checks.outcome(f"{c} is not null", F.lit(0), F.col(f"null_{c}"), F.col(f"null_{c}") == 0)
                for c in trips.FACT_KEYS
            ),
            *map(equal, amounts),
        ],
    )


def grain_checks(
    fact: DataFrame,
    daily: DataFrame,
    hourly: DataFrame,
    dims: Mapping[str, Dimension],
    slots: DataFrame | None = None,
) -> DataFrame:
    """The marts are not empty, no larger than their grain or than the fact, and stored as computed.

    ``slots`` is the table of parts the marts are made of; by default it is computed from the fact.
    """
    slots = marts.slot_parts(fact) if slots is None else slots
    days_and_zones = F.count_distinct(F.struct(*trips.DAILY_KEYS))
    found = checks.measured(
        {
            "fact": (fact, {"fact": F.count("*")}),
            "slots": (slots, {"slots": F.count("*"), "day_zones": days_and_zones}),
            "daily": (daily, {"daily": F.count("*")}),
            "hourly": (hourly, {"hourly": F.count("*")}),
            "zones": (dims["dim_zones"].rows, {"zones": F.count("*")}),
            "days": (dims["dim_date"].rows, {"days": F.count("*")}),
        }
    )
    daily_bound = F.col("zones") * F.col("days")
    hourly_bound = F.col("zones") * 7 * 24
    return checks.report(
        found,
        [
            checks.not_empty("daily mart is not empty", "daily"),
            checks.at_most("daily mart within its grain", daily_bound, F.col("daily")),
            checks.at_most("daily mart within the fact", F.col("fact"), F.col("daily")),
            checks.same_count("daily mart as computed", "day_zones", "daily"),
            checks.not_empty("hourly mart is not empty", "hourly"),
            checks.at_most("hourly mart within its grain", hourly_bound, F.col("hourly")),
            checks.at_most("hourly slots within the fact", F.col("fact"), F.col("slots")),
            checks.at_most("hourly mart within its slots", F.col("slots"), F.col("hourly")),
        ],
    )


def stored_dimensions(
    spark: SparkSession, built: Mapping[str, Dimension], gold: GoldTables
) -> dict[str, Dimension]:
    """The dimensions as stored by an earlier run; ``built`` tells their keys."""
    return {
        name: Dimension(
            tables.read(spark, gold.named(name)), dim.natural_key, dim.surrogate_key, dim.known_rows
        )
        for name, dim in built.items()
    }


def refresh(
    silver: DataFrame,
    dims: Mapping[str, Dimension],
    calendar: Calendar,
    gold: GoldTables,
    days: Sequence[int],
    scale: int | None = SCALE,
) -> dict[str, DataFrame]:
    """Recompute what depends on some days (``yyyyMMdd``) from silver; returns the fact and the marts.

    The days' fact rows, parts and daily rows are replaced, each table in one commit; the files of
    other days stay. The hourly mart is a mean over all days: it is regrouped from the parts, which
    are small beside the fact. ``days`` are calendar days, so few whatever the load.
    """
    values = sorted({(day,) for day in days})
    span = [dt.datetime.strptime(str(day), "%Y%m%d").date() for (day,) in values]
    if not span:
        raise ValueError("no days to refresh")
    # Bounds for the scan first, then the days themselves.
    rows = within(silver, trips.START, Calendar(min(span), max(span)))
    rows = rows.where(F.to_date(trips.START).isin(span))
    fact = build_fact(rows, dims, calendar)
    fact = snapshots.replace_partitions(fact, gold.named("fct_trips"), FACT_PARTITIONS, values)
    touched = tables.in_partitions(fact, FACT_PARTITIONS, values)
    slots = snapshots.replace_partitions(
        marts.slot_parts(touched, scale), gold.named("mart_slot_parts"), FACT_PARTITIONS, values
    )
    daily = snapshots.replace_partitions(
        marts.daily_from_parts(
            tables.in_partitions(slots, FACT_PARTITIONS, values), dims["dim_zones"], dims["dim_date"]
        ),
        gold.named("daily_metrics_by_zone"),
        FACT_PARTITIONS,
        values,
    )
    hourly = tables.overwrite(
        marts.hourly_from_parts(slots, dims["dim_zones"], dims["dim_date"], scale),
        gold.named("hourly_demand_patterns"),
    )
    return {"fact": fact, "slots": slots, "daily": daily, "hourly": hourly}


def run(
    silver: DataFrame,
    zones: DataFrame,
    calendar: Calendar,
    gold: GoldTables,
    max_loss: int = 100,
    scale: int | None = SCALE,
) -> DataFrame:
    """Silver to gold: writes all gold tables and returns their checks.

    ``scale`` is that of the sums in the marts and the checks (``None``: plain doubles). ``refresh`` does the
    same for the days of a later load.
    """
    spark = silver.sparkSession
    if not tables.is_path(gold.base):
        tables.ensure_database(spark, gold.base)
    dims = write_dimensions(trip_dimensions(spark, zones, calendar), gold)
    fact = write_fact(build_fact(silver, dims, calendar), gold)
    slots = tables.overwrite(
        marts.slot_parts(fact, scale), gold.named("mart_slot_parts"), FACT_PARTITIONS
    )
    daily = tables.overwrite(
        marts.daily_from_parts(slots, dims["dim_zones"], dims["dim_date"]),
        gold.named("daily_metrics_by_zone"),
        FACT_PARTITIONS,
    )
    hourly = tables.overwrite(
        marts.hourly_from_parts(slots, dims["dim_zones"], dims["dim_date"], scale),
        gold.named("hourly_demand_patterns"),
    )
    return (
        dimension_checks(dims)
        .unionByName(fact_checks(silver, fact, calendar, max_loss, scale))
        .unionByName(grain_checks(fact, daily, hourly, dims, slots))
    )
