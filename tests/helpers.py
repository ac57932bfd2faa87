"""Small frames and plan helpers for the tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

RAW_SCHEMA = """VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz,
  passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string,
  PULocationID int, DOLocationID int, payment_type bigint, fare_amount double, extra double,
  mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double,
  total_amount double, congestion_surcharge double, Airport_fee double, _source_file string"""
GOOD = {
    "VendorID": 1,
    "tpep_pickup_datetime": dt.datetime(2024, 3, 1, 8, 0),
    "tpep_dropoff_datetime": dt.datetime(2024, 3, 1, 8, 30),
    "passenger_count": 1.0,
    "trip_distance": 3.0,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 1,
    "DOLocationID": 2,
    "payment_type": 1,
    "fare_amount": 20.0,
    "extra": 0.0,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 23.5,
    "congestion_surcharge": 0.0,
    "Airport_fee": None,
    "_source_file": "f",
}


def raw_trips(spark, *changes):
    """Raw rows: the good row with the given columns changed."""
    rows = [{**GOOD, **change} for change in changes]
    names = list(GOOD)
    return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], RAW_SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def same(first, second) -> bool:
    return first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()


def at(text):
    return F.lit(text).cast("timestamp_ntz")
