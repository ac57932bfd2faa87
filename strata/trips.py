"""The trip model: the column names, rules, keys and lookups of the layered trip tables.

Everything here is a fixed value of the data contract. The operators know none of it; they get
it as arguments, so another data set needs only another module like this one.
"""

from __future__ import annotations

import datetime as dt

from strata.specs import Calendar, Column, Lookup, Role, Rule

# --- Fixed values: raw column -> silver column -> type ------------------------------------------
TRIP_COLUMNS = (
    Column("VendorID", "vendor_id"),
    Column("tpep_pickup_datetime", "pickup_datetime"),
    Column("tpep_dropoff_datetime", "dropoff_datetime"),
    Column("passenger_count", "passenger_count", "int"),
    Column("trip_distance", "trip_distance"),
    Column("RatecodeID", "rate_code_id", "int"),
    Column("store_and_fwd_flag", "store_and_fwd_flag"),
    Column("PULocationID", "pickup_location_id"),
    Column("DOLocationID", "dropoff_location_id"),
    Column("payment_type", "payment_type", "int"),
    Column("fare_amount", "fare_amount"),
    Column("extra", "extra"),
    Column("mta_tax", "mta_tax"),
    Column("tip_amount", "tip_amount"),
    Column("tolls_amount", "tolls_amount"),
    Column("improvement_surcharge", "improvement_surcharge"),
    Column("total_amount", "total_amount"),
    Column("congestion_surcharge", "congestion_surcharge"),
    Column("Airport_fee", "airport_fee"),
    Column("_source_file", "_source_file"),
)
RAW_REQUIRED = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "VendorID",
    "RatecodeID",
)
LINEAGE_TYPES = {
    "year": "int",
    "month": "int",
    "_source_file": "string",
    "_ingestion_timestamp": "timestamp",
    "_ingestion_batch_id": "string",
}
START, END = "pickup_datetime", "dropoff_datetime"
DURATION = "trip_duration_minutes"
LOADED_AT = "_silver_ingestion_timestamp"
ROW_HASH = "_row_hash"
TRIP_KEY = (
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "fare_amount",
)
HASH_SKIP = (LOADED_AT, "_source_file", "year", "month")

# --- Fixed values: lookup rows ------------------------------------------------------------------
NOT_PROVIDED = "Not Provided"
PAYMENT_TYPES = Lookup(
    "dim_payment_type",
    "payment_type_id",
    "payment_type_sk",
    "payment_type_description",
    ((1, "Credit"), (2, "Cash"), (3, "No charge"), (4, "Dispute"), (5, "Unknown"), (6, "Voided")),
)
RATE_CODES = Lookup(
    "dim_rate_code",
    "rate_code_id",
    "rate_code_sk",
    "rate_code_description",
    (
        (1, "Standard rate"),
        (2, "JFK"),
        (3, "Newark"),
        (4, "Nassau/Westchester"),
        (5, "Negotiated fare"),
        (6, "Group ride"),
    ),
)
VENDORS = Lookup(
    "dim_vendor",
    "vendor_id",
    "vendor_sk",
    "vendor_name",
    ((1, "Creative Mobile Technologies"), (2, "VeriFone Inc")),
)
ZONE_LOOKUP_COLUMNS = (
    Column("LocationID", "location_id", "int"),
    Column("Zone", "zone_name"),
    Column("Borough", "borough"),
    Column("service_zone", "service_zone"),
)
CALENDAR_2024 = Calendar(dt.date(2024, 1, 1), dt.date(2024, 12, 31))

# --- Fixed values: star schema ------------------------------------------------------------------
FACT_ROLES = (
    Role("dim_zones", "pickup_location_id", "pickup_zone_sk"),
    Role("dim_zones", "dropoff_location_id", "dropoff_zone_sk"),
    Role("dim_payment_type", "payment_type", "payment_type_sk"),
    Role("dim_rate_code", "rate_code_id", "rate_code_sk"),
    Role("dim_vendor", "vendor_id", "vendor_sk"),
)
FACT_INPUT = (
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "rate_code_id",
    "pickup_location_id",
    "dropoff_location_id",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
)
FACT_KEYS = ("pickup_date_sk",) + tuple(role.name for role in FACT_ROLES)
FACT_COLUMNS = FACT_KEYS + (
    "pickup_location_id",
    "dropoff_location_id",
    "pickup_datetime",
    "dropoff_datetime",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "trip_distance",
    "passenger_count",
    "trip_duration_seconds",
    "trip_speed_mph",
    "tip_percentage",
    "pickup_hour",
    "dropoff_hour",
)

# --- Fixed values: marts ------------------------------------------------------------------------
SLOT_KEYS = ("pickup_date_sk", "pickup_hour", "pickup_zone_sk")
SLOT_MEASURES = (
    "total_amount",
    "tip_amount",
    "fare_amount",
    "trip_distance",
    "trip_duration_seconds",
    "tip_percentage",
)
DAILY_KEYS = ("pickup_date_sk", "pickup_zone_sk")
DAILY_SUMS = {"total_amount": "total_revenue", "tip_amount": "total_tips"}
DAILY_MEANS = {
    "fare_amount": "avg_fare",
    "trip_distance": "avg_distance",
    "trip_duration_seconds": "avg_duration_seconds",
    "tip_percentage": "avg_tip_percentage",
}
DAILY_COLUMNS = (
    "pickup_date_sk",
    "pickup_zone_sk",
    "zone_name",
    "borough",
    "full_date",
    "year",
    "month",
    "day_of_week",
    "total_trips",
    "total_revenue",
    "total_tips",
    "avg_fare",
    "avg_distance",
    "avg_duration_seconds",
    "avg_tip_percentage",
)
HOURLY_COLUMNS = (
    "day_of_week",
    "pickup_hour",
    "pickup_zone_sk",
    "zone_name",
    "borough",
    "avg_trips",
    "avg_fare",
)


# --- Fixed values: the bounds of the row rules --------------------------------------------------
def trip_rules(
    max_fare: float = 500,
    max_distance: float = 200,
    passengers: tuple[int, int] = (1, 6),
    max_minutes: float = 180,
) -> tuple[Rule, ...]:
    """The eight row rules; the defaults are the contract's bounds."""
    fewest, most = passengers
    return (
        Rule("fare_amount", ("fare_amount",), f"fare_amount > 0 AND fare_amount <= {max_fare}"),
        Rule(
            "trip_distance",
            ("trip_distance",),
            f"trip_distance > 0 AND trip_distance <= {max_distance}",
        ),
        Rule(
            "passenger_count",
            ("passenger_count",),
            f"passenger_count >= {fewest} AND passenger_count <= {most}",
        ),
        Rule("datetime_order", (START, END), f"{END} > {START}"),
        Rule("trip_duration", (DURATION,), f"{DURATION} <= {max_minutes}"),
        Rule("total_amount", ("total_amount",), "total_amount > 0"),
        Rule("tip_amount", ("tip_amount",), "tip_amount >= 0"),
        Rule("tolls_amount", ("tolls_amount",), "tolls_amount >= 0"),
    )
