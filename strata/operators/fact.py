"""The fact table: derived measures and resolved dimension keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import expressions as X
from strata.operators.joins import lookup_join
from strata.specs import Calendar, Role
from strata.trips import END, FACT_COLUMNS, FACT_INPUT, FACT_KEYS, FACT_ROLES, START


@dataclass(frozen=True)
class Dimension:
    """A dimension frame with its key columns; ``known_rows`` if its size is known beforehand."""

    rows: DataFrame
    natural_key: str
    surrogate_key: str
    known_rows: int | None = None


def within(df: DataFrame, ts: str, calendar: Calendar) -> DataFrame:
    """The rows whose timestamp falls on a day of the calendar.

    A half-open range on the timestamp itself, so it is pushed into the Parquet scan. Where the
    table is partitioned by the year of that timestamp, the year bound prunes its partitions.
    """
    kind = dict(df.dtypes)[ts]
    first, end = (F.lit(str(day)).cast(kind) for day in (calendar.first, calendar.end))
    rows = df.where((F.col(ts) >= first) & (F.col(ts) < end))
    if "year" in df.columns:
        rows = rows.where(F.col("year").between(calendar.first.year, calendar.last.year))
    return rows


def derived_measures(df: DataFrame) -> DataFrame:
    """Duration in seconds, speed, tip percentage, and the hours of both ends."""
    seconds = F.col("trip_duration_seconds")
    distance, tip, fare = F.col("trip_distance"), F.col("tip_amount"), F.col("fare_amount")
    return df.withColumn("trip_duration_seconds", X.seconds_between(START, END)).withColumns(
        {
            "trip_speed_mph": F.when(seconds > 0, distance / (seconds / F.lit(3600.0))),
            "tip_percentage": X.positive_ratio(tip, fare) * F.lit(100.0),
            "pickup_hour": F.hour(START),
            "dropoff_hour": F.hour(END),
        }
    )


def resolve_keys(
    df: DataFrame, dimensions: Mapping[str, Dimension], roles: Sequence[Role]
) -> DataFrame:
    """Add one surrogate key per role; a NULL or unknown reference becomes 0."""
    references = {role.name: f"_ref_{role.name}" for role in roles}
    df = df.withColumns(
        {references[r.name]: F.coalesce(F.col(r.source), F.lit(0)) for r in roles}
    )
    for role in roles:
        dim, reference = dimensions[role.dimension], references[role.name]
        keys = dim.rows.select(
            F.col(dim.natural_key).alias(reference), F.col(dim.surrogate_key).alias(role.name)
        )
        df = lookup_join(df, keys, reference, known_rows=dim.known_rows)
    found = {r.name: F.coalesce(F.col(r.name), F.lit(0)).cast("bigint") for r in roles}
    return df.withColumns(found).drop(*references.values())


def build_fact(
    silver: DataFrame, dimensions: Mapping[str, Dimension], calendar: Calendar
) -> DataFrame:
    """One fact row per silver row that starts inside the calendar.

    The date key has no default member: a day missing from the date dimension shows as NULL.
    """
    missing = sorted(set(FACT_INPUT) - set(silver.columns))
    if missing:
        raise ValueError(f"silver lacks {missing}")
    partition = ["year"] if "year" in silver.columns else []
    trips = within(silver.select(*FACT_INPUT, *partition), START, calendar)
    trips = derived_measures(trips).withColumn("_day", X.date_key(F.col(START)))
    date = dimensions["dim_date"]
    day_keys = date.rows.select(
        F.col(date.surrogate_key).alias("_day"),
        F.col(date.surrogate_key).alias("pickup_date_sk"),
    )
    trips = lookup_join(trips, day_keys, "_day", known_rows=date.known_rows)
    return resolve_keys(trips, dimensions, FACT_ROLES).select(*FACT_COLUMNS)


def resolve_labels(
    fact: DataFrame, dimensions: Mapping[str, Dimension], order_by: Sequence[str], n: int
) -> DataFrame:
    """The first ``n`` fact rows with the labels behind their keys.

    The rows are taken first, so the labels are looked up for ``n`` rows only.
    """
    shown = (*FACT_KEYS, "pickup_location_id", "dropoff_location_id", "pickup_datetime")
    rows = fact.select(*shown).orderBy(*order_by).limit(n)
    labels = (
        ("dim_date", "pickup_date_sk", "full_date", "pickup_full_date"),
        ("dim_zones", "pickup_zone_sk", "zone_name", "pickup_zone_name"),
        ("dim_zones", "dropoff_zone_sk", "zone_name", "dropoff_zone_name"),
        ("dim_payment_type", "payment_type_sk", "payment_type_description", None),
        ("dim_rate_code", "rate_code_sk", "rate_code_description", None),
        ("dim_vendor", "vendor_sk", "vendor_name", None),
    )
    for name, key, label, alias in labels:
        dim = dimensions[name]
        side = dim.rows.select(
            F.col(dim.surrogate_key).alias(key), F.col(label).alias(alias or label)
        )
        rows = lookup_join(rows, side, key, known_rows=dim.known_rows)
    return rows.select(
        "pickup_datetime",
        "pickup_date_sk",
        "pickup_full_date",
        "pickup_location_id",
        "pickup_zone_sk",
        "pickup_zone_name",
        "dropoff_location_id",
        "dropoff_zone_sk",
        "dropoff_zone_name",
        "payment_type_sk",
        "payment_type_description",
        "rate_code_sk",
        "rate_code_description",
        "vendor_sk",
        "vendor_name",
    )
