"""The ten reports over the gold tables.

Reports over the fact group it by integer keys first and look the labels up for the groups; the
second grouping merges members that share a label. Sorts end with the labels, so that equal
values come in a fixed order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.functions import totals as S
from strata.functions.expressions import weekday_name
from strata.operators.fact import Dimension
from strata.operators.joins import lookup_join


def _label(rows: DataFrame, dim: Dimension, key: str, **labels: str) -> DataFrame:
    columns = [F.col(source).alias(name) for name, source in labels.items()]
    side = dim.rows.select(F.col(dim.surrogate_key).alias(key), *columns)
    return lookup_join(rows, side, key, "inner", dim.known_rows)


def _share(total_window) -> F.Column:
    share = F.col("trip_count") * 100.0 / F.sum("trip_count").over(total_window)
    return F.round(share.cast("double"), 2)


def _groups(fact: DataFrame, keys: list[str], means: list[str], scale: int | None) -> DataFrame:
    parts = [part for name in means for part in S.parts(name, scale)]
    return fact.groupBy(*keys).agg(F.count("*").alias("_trips"), *parts)


def top_zones_by_revenue(daily: DataFrame, scale: int | None = None, n: int = 10) -> DataFrame:
    """q01: the zones with the highest revenue, and revenue per trip."""
    trips, revenue = F.sum("total_trips"), S.total(F.col("total_revenue"), scale)
    return (
        daily.groupBy("zone_name", "borough")
        .agg(
            trips.alias("total_trips"),
            F.round(revenue, 2).alias("total_revenue"),
            F.round(revenue / trips, 2).alias("avg_revenue_per_trip"),
        )
        .orderBy(F.desc("total_revenue"), "zone_name", "borough")
        .limit(n)
    )


def busiest_slots(hourly: DataFrame, borough: str, n: int = 50) -> DataFrame:
    """q02: the busiest (zone, hour) slots of a borough; one row per weekday, as in the mart."""
    return (
        hourly.where(F.col("borough") == borough)
        .select(
            "pickup_hour",
            "zone_name",
            F.round("avg_trips", 2).alias("avg_trips"),
            F.round("avg_fare", 2).alias("avg_fare"),
        )
        .orderBy(F.desc("avg_trips"), "pickup_hour", "zone_name", F.desc("avg_fare"))
        .limit(n)
    )


def weekday_demand(hourly: DataFrame, scale: int | None = None) -> DataFrame:
    """q03: demand per day of the week."""
    return (
        hourly.groupBy("day_of_week")
        .agg(
            F.round(S.total(F.col("avg_trips"), scale), 1).alias("total_avg_demand"),
            F.round(S.mean(F.col("avg_fare"), scale), 2).alias("avg_fare"),
        )
        .select(
            "day_of_week",
            weekday_name(F.col("day_of_week")).alias("day_name"),
            "total_avg_demand",
            "avg_fare",
        )
        .orderBy(F.desc("total_avg_demand"), "day_of_week")
    )


def payment_mix(fact: DataFrame, payments: Dimension, scale: int | None = None) -> DataFrame:
    """q04: trips, share of all trips and tips per payment type."""
    means = ["tip_amount", "tip_percentage"]
    rows = _label(
        _groups(fact, ["payment_type_sk"], means, scale),
        payments,
        "payment_type_sk",
        payment_type_description="payment_type_description",
    )
    grouped = rows.groupBy("payment_type_description").agg(
        F.sum("_trips").alias("trip_count"),
        F.round(S.merged_mean("tip_amount"), 2).alias("avg_tip_amount"),
        F.round(S.merged_mean("tip_percentage"), 2).alias("avg_tip_pct"),
    )
    return grouped.select(
        "payment_type_description",
        "trip_count",
        # One row per payment type, so a window over all of them is one small task.
        _share(Window.partitionBy()).alias("pct_of_trips"),
        "avg_tip_amount",
        "avg_tip_pct",
    ).orderBy(F.desc("trip_count"), "payment_type_description")


def vendor_share(fact: DataFrame, vendors: Dimension, dates: Dimension) -> DataFrame:
    """q05: share of trips per vendor and month; the unknown vendor is left out of the total."""
    known = Dimension(
        vendors.rows.where(F.col(vendors.natural_key) != 0),
        vendors.natural_key,
        vendors.surrogate_key,
        vendors.known_rows,
    )
    rows = _groups(fact, ["pickup_date_sk", "vendor_sk"], [], None)
    rows = _label(rows, known, "vendor_sk", vendor_name="vendor_name")
    rows = _label(rows, dates, "pickup_date_sk", year="year", month="month")
    grouped = rows.groupBy("year", "month", "vendor_name").agg(F.sum("_trips").alias("trip_count"))
    share = _share(Window.partitionBy("year", "month"))
    return grouped.withColumn("market_share_pct", share).orderBy(
        "year", "month", F.desc("trip_count"), "vendor_name"
    )


def short_costly_trips(
    fact: DataFrame,
    zones: Dimension,
    max_distance: float = 0.5,
    min_fare: float = 20.0,
    scale: int | None = None,
) -> DataFrame:
    """q06: trips shorter than ``max_distance`` that cost more than ``min_fare``, per borough."""
    odd = fact.where(
        (F.col("trip_distance") < max_distance)
        & (F.col("fare_amount") > min_fare)
        & (F.col("pickup_zone_sk") != 0)
    )
    means = ["fare_amount", "trip_distance", "trip_duration_seconds"]
    rows = _label(
        _groups(odd, ["pickup_zone_sk"], means, scale), zones, "pickup_zone_sk", borough="borough"
    )
    return (
        rows.groupBy("borough")
        .agg(
            F.sum("_trips").alias("trip_count"),
            F.round(S.merged_mean("fare_amount"), 2).alias("avg_fare"),
            F.round(S.merged_mean("trip_distance"), 3).alias("avg_distance_miles"),
            F.round(S.merged_mean("trip_duration_seconds") / 60.0, 1).alias("avg_duration_minutes"),
        )
        .orderBy(F.desc("trip_count"), "borough")
    )


def top_routes(
    fact: DataFrame, zones: Dimension, scale: int | None = None, n: int = 10
) -> DataFrame:
    """q07: the busiest pairs of pickup and dropoff zone."""
    known = fact.where((F.col("pickup_zone_sk") != 0) & (F.col("dropoff_zone_sk") != 0))
    means = ["trip_duration_seconds", "trip_distance", "fare_amount"]
    rows = _groups(known, ["pickup_zone_sk", "dropoff_zone_sk"], means, scale)
    rows = _label(rows, zones, "pickup_zone_sk", pickup_zone="zone_name")
    rows = _label(rows, zones, "dropoff_zone_sk", dropoff_zone="zone_name")
    return (
        rows.groupBy("pickup_zone", "dropoff_zone")
        .agg(
            F.sum("_trips").alias("trip_count"),
            F.round(S.merged_mean("trip_duration_seconds") / 60.0, 1).alias("avg_duration_minutes"),
            F.round(S.merged_mean("trip_distance"), 2).alias("avg_distance_miles"),
            F.round(S.merged_mean("fare_amount"), 2).alias("avg_fare"),
        )
        .orderBy(F.desc("trip_count"), "pickup_zone", "dropoff_zone")
        .limit(n)
    )


def fare_per_mile(fact: DataFrame, zones: Dimension, scale: int | None = None) -> DataFrame:
    """q08: the mean of the fare per mile of each trip, per borough."""
    moving = fact.where((F.col("trip_distance") > 0) & (F.col("pickup_zone_sk") != 0)).withColumn(
        "fare_rate", F.col("fare_amount") / F.col("trip_distance")
    )
    means = ["fare_amount", "trip_distance", "fare_rate"]
    rows = _label(
        _groups(moving, ["pickup_zone_sk"], means, scale),
        zones,
        "pickup_zone_sk",
        borough="borough",
    )
    return (
        rows.groupBy("borough")
        .agg(
            F.sum("_trips").alias("trip_count"),
            F.round(S.merged_mean("fare_amount"), 2).alias("avg_fare"),
            F.round(S.merged_mean("trip_distance"), 2).alias("avg_distance_miles"),
            F.round(S.merged_mean("fare_rate"), 2).alias("avg_fare_per_mile"),
        )
        .orderBy(F.desc("avg_fare_per_mile"), "borough")
    )


def weekend_vs_weekday(daily: DataFrame, scale: int | None = None) -> DataFrame:
    """q09: mean trips and revenue per day, weekdays against weekends."""
    per_day = daily.groupBy("pickup_date_sk", "day_of_week").agg(
        F.sum("total_trips").alias("day_trips"),
        S.total(F.col("total_revenue"), scale).alias("day_revenue"),
    )
    kind = F.when(F.col("day_of_week").isin(6, 7), "Weekend").otherwise("Weekday")
    return (
        per_day.groupBy(kind.alias("day_type"))
        .agg(
            F.count("*").alias("num_days"),
            F.round(F.avg("day_trips"), 0).alias("avg_trips_per_day"),
            F.round(S.mean(F.col("day_revenue"), scale), 2).alias("avg_revenue_per_day"),
        )
        .orderBy(F.desc("avg_trips_per_day"), "day_type")
    )


def monthly_trend(daily: DataFrame, scale: int | None = None) -> DataFrame:
    """q10: trips, revenue and the unweighted mean of the daily means, per month."""
    return (
        daily.groupBy("year", "month")
        .agg(
            F.sum("total_trips").alias("total_trips"),
            F.round(S.total(F.col("total_revenue"), scale), 2).alias("total_revenue"),
            F.round(S.mean(F.col("avg_fare"), scale), 2).alias("avg_fare"),
            F.round(S.mean(F.col("avg_distance"), scale), 2).alias("avg_distance_miles"),
        )
        .orderBy("year", "month")
    )
