"""The given tables in the shape of raw trips.

``order_trips``: every order line is a trip from its supplier's nation to its customer's nation.
``event_trips``: every event is a trip that takes as many seconds as its value.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.specs import Calendar
from strata.trips import trip_rules

ORDER_CALENDAR = Calendar(dt.date(1995, 1, 1), dt.date(2001, 12, 31))
ORDER_RULES = trip_rules(
    max_fare=90_000, max_distance=45, passengers=(1, 48), max_minutes=1_500_000
)
EVENT_RULES = trip_rules(max_fare=300)
# A fixed load time keeps results the same on every run.
LOAD_TIME = "2024-07-01 00:00:00"
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


# The given tables have fixed columns; declared, they need no job that looks into a footer.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def load_time() -> Column:
    return F.lit(LOAD_TIME).cast("timestamp_ntz")


def _no_value(kind: str) -> Column:
    return F.lit(None).cast(kind)


def order_trips(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Order lines as trips; ``more`` are further columns as SQL text."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # The short sides are joined first, so the order lines are shuffled once, by their order.
    sold = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    joined = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(
        sold, F.col("l_orderkey") == F.col("o_orderkey")
    )
    flag = F.col("l_returnflag")
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return joined.select(
        F.when(flag == "A", 1).when(flag == "N", 2).alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_quantity").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_linenumber").cast("double").alias("RatecodeID"),
        F.col("l_linestatus").alias("store_and_fwd_flag"),
        (F.col("s_nationkey") + 1).alias("PULocationID"),
        (F.col("c_nationkey") + 1).alias("DOLocationID"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("payment_type"),
        price.alias("fare_amount"),
        F.lit(0.0).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (price * discount).alias("tip_amount"),
        (price * tax).alias("tolls_amount"),
        F.lit(0.0).alias("improvement_surcharge"),
        (price * (1 - discount) * (1 + tax)).alias("total_amount"),
        _no_value("double").alias("congestion_surcharge"),
        _no_value("double").alias("Airport_fee"),
        F.lit("lineitem").alias("_source_file"),
        *map(F.expr, more),
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    number, value = F.col("event_id"), F.col("value")
    tip = value * (number % 20) / 100.0
    kind = F.array_position(F.array(*[F.lit(t) for t in EVENT_TYPES]), F.col("event_type"))
    return events.select(
        F.when(number % 3 != 0, number % 3).cast("int").alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        F.expr("timestampadd(SECOND, CAST(floor(value) AS INT), ts)").alias(
            "tpep_dropoff_datetime"
        ),
        (number % 8).cast("double").alias("passenger_count"),
        ((number % 200).cast("double") / 10.0).alias("trip_distance"),
        (number % 7 + 1).cast("double").alias("RatecodeID"),
        F.lit("N").alias("store_and_fwd_flag"),
        (F.col("user_id") % 25 + 1).cast("int").alias("PULocationID"),
        (number % 27 + 1).cast("int").alias("DOLocationID"),
        kind.alias("payment_type"),
        value.alias("fare_amount"),
        F.lit(0.0).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        tip.alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.0).alias("improvement_surcharge"),
        (value + tip).alias("total_amount"),
        _no_value("double").alias("congestion_surcharge"),
        _no_value("double").alias("Airport_fee"),
        F.lit("events").alias("_source_file"),
    )


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones and regions as boroughs, spelt like the lookup file."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        (F.col("n_nationkey") + 1).alias("LocationID"),
        F.col("n_name").alias("Zone"),
        F.col("r_name").alias("Borough"),
        F.concat(F.lit("zone "), F.col("n_regionkey")).alias("service_zone"),
    )
