import datetime as dt

import pytest
from helpers import at, plan_of, raw_trips, rows_of, same
from pyspark.sql import functions as F

from strata import trips
from strata.operators import checks, marts, profile
from strata.operators.dimensions import date_dimension, days, dimension, key_sample, lookup_dimension
from strata.operators.fact import Dimension, build_fact, resolve_labels, within
from strata.operators.joins import lookup_join
from strata.operators.keys import dense_key
from strata.plans import gold, reports, silver
from strata.sources import tables
from strata.specs import Calendar, Lookup

YEAR = trips.CALENDAR_2024


def zones(spark):
    return spark.createDataFrame(
        [(7, "Pier", "Manhattan", "Z"), (1, "Airport", "Queens", "Z"), (3, "Pier", "Manhattan", "Z")],
        "location_id int, zone_name string, borough string, service_zone string",
    )


def dimensions(spark):
    return gold.trip_dimensions(spark, zones(spark), YEAR)


def trip(spark, *changes):
    return silver.normalized_trips(raw_trips(spark, *changes), at("2024-07-01 00:00:00"))


def fact(spark, *changes):
    return build_fact(trip(spark, *changes), dimensions(spark), YEAR)


def test_dimensions_have_a_default_member_and_dense_keys(spark):
    dims = dimensions(spark)
    assert rows_of(dims["dim_zones"].rows, "zone_sk", "location_id", "zone_name", "borough") == [
        (0, 0, "Not Provided", None),
        (1, 1, "Airport", "Queens"),
        (2, 3, "Pier", "Manhattan"),
        (3, 7, "Pier", "Manhattan"),
    ]
    assert {n: d.rows.count() for n, d in dims.items()} == {
        "dim_zones": 4, "dim_date": 366, "dim_payment_type": 7, "dim_rate_code": 7, "dim_vendor": 3,
    }
    assert checks.failed(gold.dimension_checks(dims)).isEmpty()


def test_lookup_with_duplicate_keys_is_refused(spark):
    with pytest.raises(ValueError):
        lookup_dimension(spark, Lookup("d", "id", "sk", "t", ((1, "a"), (1, "b"))), "none")


def test_calendar(spark):
    rows = date_dimension(days(spark, Calendar(dt.date(2024, 2, 28), dt.date(2024, 3, 3))))
    assert rows_of(rows, "date_sk", "day_of_week", "day_name", "is_weekend", "quarter") == [
        (20240228, 3, "Wednesday", False, 1),
        (20240229, 4, "Thursday", False, 1),
        (20240301, 5, "Friday", False, 1),
        (20240302, 6, "Saturday", True, 1),
        (20240303, 7, "Sunday", True, 1),
    ]


def test_range_numbering_equals_one_window(spark):
    rows = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    ranged = dense_key(rows, "k", "sk", one_task_rows=10)
    single = dense_key(rows, "k", "sk")
    assert same(ranged, single)
    assert "SinglePartition" in plan_of(single)
    assert rows_of(key_sample(ranged, "k", "sk", 3), "sk") == [(1,), (2,), (3,)]


def test_range_numbering_keeps_a_null_key_first(spark):
    rows = spark.createDataFrame([(2,), (None,), (1,)], "k int")
    assert rows_of(dense_key(rows, "k", "sk", one_task_rows=0), "sk", "k") == [
        (1, None), (2, 1), (3, 2),
    ]


def test_unknown_null_and_zero_references_get_the_default_member(spark):
    rows = fact(
        spark,
        {"PULocationID": None, "DOLocationID": 0, "payment_type": 99, "RatecodeID": None},
        {"PULocationID": 3, "DOLocationID": 2, "VendorID": None},
    )
    assert rows_of(
        rows, "pickup_zone_sk", "dropoff_zone_sk", "payment_type_sk", "rate_code_sk", "vendor_sk"
    ) == [(0, 0, 0, 0, 1), (2, 0, 1, 1, 0)]
    assert tuple(rows.columns) == trips.FACT_COLUMNS


def test_calendar_edges(spark):
    edge = lambda *parts: {
        "tpep_pickup_datetime": dt.datetime(*parts),
        "tpep_dropoff_datetime": dt.datetime(2025, 1, 2),
    }
    rows = fact(
        spark,
        edge(2023, 12, 31, 23, 59, 59),
        edge(2024, 1, 1),
        edge(2024, 12, 31, 23, 59, 59, 500000),
        edge(2025, 1, 1),
        {"tpep_pickup_datetime": None},
    )
    assert rows_of(rows, "pickup_date_sk") == [(20240101,), (20241231,)]


def test_guarded_measures(spark):
    start = dt.datetime(2024, 3, 1, 8, 0)
    rows = fact(
        spark,
        {},
        {"tpep_dropoff_datetime": start, "fare_amount": 0.0},
        {"tpep_dropoff_datetime": None, "fare_amount": None},
    )
    columns = ["trip_duration_seconds", "trip_speed_mph", "tip_percentage", "dropoff_hour"]
    assert rows_of(rows, *columns) == [
        (0, None, None, 8), (1800, 6.0, 10.0, 8), (None, None, None, None),
    ]


def test_calendar_filter_is_pushed_and_prunes(spark, folder):
    stored = tables.overwrite(trip(spark, {}), f"{folder}/s", ["year", "month"])
    plan = plan_of(within(stored, "pickup_datetime", YEAR))
    assert "GreaterThanOrEqual(pickup_datetime,2024-01-01" in plan
    assert "PartitionFilters: [isnotnull(year" in plan


def test_fact_joins_are_broadcast_within_the_bound_only(spark):
    assert "SortMergeJoin" not in plan_of(fact(spark, {}))
    big = spark.range(50).withColumnRenamed("id", "k")
    rows = spark.range(50).select(F.col("id").alias("k"))
    assert "ResolvedHint" not in str(
        lookup_join(rows, big, "k", max_rows=10)._jdf.queryExecution().analyzed()
    )
    assert "ResolvedHint (strategy=broadcast)" in str(
        lookup_join(rows, big, "k", max_rows=50)._jdf.queryExecution().analyzed()
    )


def daily_and_hourly(spark):
    """Two Mondays and a Saturday at one zone."""
    monday, second, saturday = dt.date(2024, 3, 4), dt.date(2024, 3, 11), dt.date(2024, 3, 9)
    ride = lambda day, hour, fare, zone=3: {
        "tpep_pickup_datetime": dt.datetime.combine(day, dt.time(hour)),
        "tpep_dropoff_datetime": dt.datetime.combine(day, dt.time(hour, 30)),
        "fare_amount": fare,
        "total_amount": fare + 1,
        "tip_amount": 1.0,
        "PULocationID": zone,
    }
    rows = fact(
        spark,
        ride(monday, 8, 10.0),
        ride(monday, 8, 20.0),
        ride(monday, 8, 30.0),
        ride(second, 8, 40.0),
        ride(saturday, 9, 50.0, 7),
        ride(saturday, 9, 5.0, None),
    )
    dims = dimensions(spark)
    args = (rows, dims["dim_zones"], dims["dim_date"])
    return rows, dims, marts.daily_metrics(*args), marts.hourly_patterns(*args)


def test_marts_and_their_reports(spark):
    rows, dims, daily, hourly = daily_and_hourly(spark)
    assert rows_of(daily, "pickup_date_sk", "pickup_zone_sk", "total_trips", "avg_fare") == [
        (20240304, 2, 3, 20.0),
        (20240309, 0, 1, 5.0),
        (20240309, 3, 1, 50.0),
        (20240311, 2, 1, 40.0),
    ]
    # (3 + 1) / 2 trips; mean of the means 20 and 40; hours without trips do not count.
    assert rows_of(hourly, "day_of_week", "pickup_hour", "pickup_zone_sk", "avg_trips", "avg_fare") == [
        (1, 8, 2, 2.0, 30.0), (6, 9, 0, 1.0, 5.0), (6, 9, 3, 1.0, 50.0),
    ]
    # Zones 3 and 7 share a name and become one; the unknown zone stays.
    assert rows_of(reports.top_zones_by_revenue(daily), "*") == [
        ("Not Provided", None, 1, 6.0, 6.0), ("Pier", "Manhattan", 5, 155.0, 31.0),
    ]
    assert rows_of(reports.busiest_slots(hourly, "Manhattan"), "*") == [
        (8, "Pier", 2.0, 30.0), (9, "Pier", 1.0, 50.0),
    ]
    assert rows_of(reports.weekday_demand(hourly), "*") == [
        (1, "Monday", 2.0, 30.0), (6, "Saturday", 2.0, 27.5),
    ]
    assert rows_of(reports.weekend_vs_weekday(daily), "*") == [
        ("Weekday", 2, 2.0, 52.0), ("Weekend", 1, 2.0, 57.0),
    ]
    assert rows_of(reports.monthly_trend(daily), "*") == [(2024, 3, 6, 161.0, 28.75, 3.0)]
    assert rows_of(reports.payment_mix(rows, dims["dim_payment_type"]), "*") == [
        ("Credit", 6, 100.0, 1.0, 7.14),
    ]
    assert checks.failed(gold.grain_checks(rows, daily, hourly, dims)).isEmpty()


def test_fixed_point_sums_equal_plain_sums(spark):
    rows, dims, daily, hourly = daily_and_hourly(spark)
    args = (rows, dims["dim_zones"], dims["dim_date"], 9)
    assert same(daily.drop("avg_tip_percentage"), marts.daily_metrics(*args).drop("avg_tip_percentage"))
    rounded = "round(avg_tip_percentage, 8) AS t"
    assert same(daily.selectExpr(rounded), marts.daily_metrics(*args).selectExpr(rounded))
    assert same(hourly, marts.hourly_patterns(*args))


def test_reports_that_drop_the_unknown_member(spark):
    far = {"trip_distance": 0.2, "fare_amount": 30.0, "PULocationID": 3, "DOLocationID": 1}
    rows = fact(
        spark,
        far,
        {**far, "VendorID": 2, "PULocationID": 7},
        {**far, "VendorID": None},
        {**far, "PULocationID": None},
        {**far, "trip_distance": 0.0, "PULocationID": 1},
    )
    dims = dimensions(spark)
    share = reports.vendor_share(rows, dims["dim_vendor"], dims["dim_date"])
    assert rows_of(share, "vendor_name", "trip_count", "market_share_pct") == [
        ("Creative Mobile Technologies", 3, 75.0), ("VeriFone Inc", 1, 25.0),
    ]
    short = reports.short_costly_trips(rows, dims["dim_zones"])
    assert rows_of(short, "borough", "trip_count", "avg_distance_miles") == [
        ("Manhattan", 3, 0.2), ("Queens", 1, 0.0),
    ]
    routes = reports.top_routes(rows, dims["dim_zones"])
    assert rows_of(routes, "pickup_zone", "dropoff_zone", "trip_count") == [
        ("Airport", "Airport", 1), ("Pier", "Airport", 3),
    ]
    per_mile = reports.fare_per_mile(rows, dims["dim_zones"])
    assert rows_of(per_mile, "borough", "trip_count", "avg_fare_per_mile") == [
        ("Manhattan", 3, 150.0),
    ]


def test_gold_run_is_repeatable_and_checked(spark, folder):
    rows = trip(spark, {}, {"VendorID": None}, {"tpep_pickup_datetime": dt.datetime(2023, 1, 1)})
    stored = tables.overwrite(rows, f"{folder}/s", ["year", "month"])
    target = gold.GoldTables(f"{folder}/gold")
    report = gold.run(stored, zones(spark), YEAR, target)
    assert checks.failed(report).isEmpty()
    first = {n: tables.read(spark, target.named(n)).collect() for n in ("dim_zones", "fct_trips")}
    gold.run(stored, zones(spark), YEAR, target)
    for name, before in first.items():
        after = tables.read(spark, target.named(name)).collect()
        assert sorted(map(repr, before)) == sorted(map(repr, after))
    strict = gold.run(stored, zones(spark), YEAR, target, max_loss=0)
    assert [r.check for r in checks.failed(strict).collect()] == ["rows lost at the calendar edge"]


def files_by_day(rows):
    found = rows.select("pickup_date_sk", F.col("_metadata.file_path").alias("f")).distinct().collect()
    return {r.pickup_date_sk: r.f for r in found}


def test_a_refresh_rewrites_only_the_days_it_is_given(spark, folder):
    day = lambda d, fare: {
        "tpep_pickup_datetime": dt.datetime(2024, 3, d, 8), "tpep_dropoff_datetime": dt.datetime(2024, 3, d, 9),
        "PULocationID": 3, "fare_amount": fare,
    }
    first = trip(spark, day(1, 10.0), day(2, 20.0), day(3, 30.0))
    target = gold.GoldTables(f"{folder}/gold")
    gold.run(first, zones(spark), YEAR, target)
    names = ("fct_trips", "mart_slot_parts", "daily_metrics_by_zone")
    before = {n: files_by_day(tables.read(spark, target.named(n))) for n in names}
    # Day 2 changes, day 3 goes, day 4 comes; day 1 has a new row too, but is not refreshed.
    later = trip(spark, day(1, 10.0), day(1, 11.0), day(2, 21.0), day(2, 29.0), day(4, 40.0))
    dims = gold.stored_dimensions(spark, dimensions(spark), target)
    made = gold.refresh(later, dims, YEAR, target, [20240302, 20240303, 20240304])
    assert rows_of(made["daily"], "pickup_date_sk", "total_trips", "avg_fare") == [
        (20240301, 1, 10.0), (20240302, 2, 25.0), (20240304, 1, 40.0),
    ]
    for name in names:
        after = files_by_day(tables.read(spark, target.named(name)))
        assert after[20240301] == before[name][20240301]
        assert after[20240302] != before[name][20240302]
        assert set(after) == {20240301, 20240302, 20240304}
    whole = gold.run(later.where("day(pickup_datetime) > 1").unionAll(first.where("day(pickup_datetime) = 1")),
                     zones(spark), YEAR, gold.GoldTables(f"{folder}/whole"))
    assert checks.failed(whole).isEmpty()
    for name in (*names, "hourly_demand_patterns"):
        again = tables.read(spark, f"{folder}/whole/{name}")
        assert same(tables.read(spark, target.named(name)).select(*again.columns), again)


def test_labels_of_a_sample(spark):
    rows = fact(spark, {"PULocationID": 3}, {"VendorID": 2, "fare_amount": 1.0})
    labelled = resolve_labels(rows, dimensions(spark), ["fare_amount"], 1)
    assert rows_of(labelled, "vendor_name", "pickup_zone_name", "dropoff_zone_name") == [
        ("VeriFone Inc", "Airport", "Not Provided"),
    ]


def test_sample_lineage_drops_null_locations_and_can_fan_out(spark):
    silver_rows = trip(spark, {}, {"PULocationID": None}, {"VendorID": 2})
    dims = dimensions(spark)
    found = checks.sample_lineage(
        silver_rows,
        build_fact(silver_rows, dims, YEAR),
        dims["dim_zones"].rows,
        dims["dim_date"].rows,
        F.col("pickup_datetime") >= "2024-03-01",
        ["pickup_datetime"],
        5,
    )
    # Two rows agree in the four columns compared, so each finds both.
    assert found.count() == 4


def test_checks(spark):
    left = spark.createDataFrame([(1, 1.0), (2, 2.0), (None, 3.0)], "k int, v double")
    assert rows_of(checks.null_checks(left, ["k", "v"]), "check", "actual", "passed") == [
        ("k is not null", "1", False), ("v is not null", "0", True),
    ]
    keys = checks.key_checks(spark.createDataFrame([(1, 5), (1, 6)], "sk int, nk int"), "sk", "nk")
    assert rows_of(keys, "check", "passed") == [
        ("nk is unique", True), ("sk is not null", True), ("sk is unique", False),
    ]
    empty = left.where("false")
    sums = checks.sum_checks(left, empty, ["v"], 0.01).first()
    assert (sums.left_sum, sums.right_sum, sums.passed) == (6.0, 0.0, False)
    assert checks.sum_checks(empty, empty, ["v"], 0.01).first().passed
    assert checks.same_rows("r", left, left).first().passed
    assert not checks.same_rows("r", left, left.limit(2)).first().passed
    assert checks.same_fingerprint("f", left, left.repartition(3)).first().passed
    changed = left.withColumn("v", F.when(F.col("k") == 1, F.lit(9.5)).otherwise(F.col("v")))
    report = checks.same_fingerprint("f", left, changed).first()
    assert not report.passed and report.expected != report.actual
    assert not checks.same_fingerprint("f", left, left.unionAll(left)).first().passed
    assert checks.same_fingerprint("f", left.where("false"), left.where("false")).first().passed
    assert "hashpartitioning" not in plan_of(checks.same_fingerprint("f", left, left))
    difference = checks.set_difference(left.select("k"), spark.createDataFrame([(2,), (4,)], "k int"))
    assert rows_of(difference, "k", "status") == [
        (1, "unexpected"), (4, "missing"), (None, "unexpected"),
    ]


def test_rogue_dates_ignore_null_and_only_warn(spark):
    rows = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 9, 1),), (None,)], "t timestamp_ntz"
    )
    row = checks.out_of_range_share(rows, "dates", "t", 2024, (1, 6))
    assert (row.first().actual, row.first().severity, row.first().rows_seen) == ("1", "warn", 3)
    checks.require(row)


def test_profile(spark):
    rows = spark.createDataFrame(
        [(1, None, 1.0), (1, None, 2.0), (2, "x", None)], "a int, b string, v double"
    )
    assert [tuple(r) for r in profile.null_rates(rows).collect()] == [
        ("b", 2, 200.0 / 3), ("v", 1, 100.0 / 3), ("a", 0, 0.0),
    ]
    # A key with a NULL part counts as a key.
    keys = profile.duplicate_keys(rows, {"ab": ["a", "b"]}).first()
    assert (keys.total_rows, keys.distinct_keys, keys.duplicate_rows) == (3, 2, 1)
    for quantiles in ("sketch", "exact"):
        numbers = profile.numeric_profile(rows, "v", F.col("v") <= 1, F.col("v") > 5, None, quantiles).first()
        assert (numbers.min_value, numbers.max_value, numbers.too_low, numbers.too_high) == (1, 2, 1, 0)
        assert (numbers.mean_value, numbers.p50_value, numbers.p99_value) == (1.5, 1.0, 2.0)
        none = profile.numeric_profile(rows.where("false"), "v", F.col("v") <= 1, F.col("v") > 5, 9, quantiles).first()
        assert (none.min_value, none.mean_value, none.p50_value, none.too_low) == (None, None, None, 0)
    with pytest.raises(ValueError):
        profile.numeric_profile(rows, "v", F.col("v") <= 1, F.col("v") > 5, None, "some")
    assert rows_of(profile.value_counts(rows, "a"), "*") == [(1, 2), (2, 1)]
    stats = profile.describe(rows, ["v"]).first()
    assert (stats.value_count, stats["mean"], stats["min"], stats["max"]) == (2, 1.5, 1.0, 2.0)
    lookup = spark.createDataFrame([(1,)], "id int")
    unknown = profile.orphans(rows.withColumn("c", F.lit(None).cast("int")), ["a", "c"], lookup, "id")
    assert rows_of(unknown, "role", "id") == [("a", 2), ("c", None)]
    assert rows_of(profile.orphan_counts(unknown), "*") == [("a", 1), ("c", 1)]


def test_exact_quantiles_are_those_of_the_sorted_values(spark):
    """A third of the rows hold one value; the ranks are found range by range."""
    rows = spark.range(9001).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id") * 7919 % 5003 / 10).alias("v")
    )
    values = sorted(r.v for r in rows.collect())
    got = profile.numeric_profile(rows, "v", F.col("v") < 7, F.col("v") > 7, 9, "exact").first()
    for name, p in profile.PERCENTILES.items():
        assert got[f"{name}_value"] == values[int(-(-len(values) * p // 1)) - 1]
    assert (got.too_low, got.too_high) == (sum(v < 7 for v in values), sum(v > 7 for v in values))
    assert got.mean_value == pytest.approx(sum(values) / len(values))


def test_sketches_merge_within_their_error(spark, folder):
    rows = spark.range(60_000).select((F.col("id") % 12).alias("m"), (F.col("id") * 7919 % 59_999).alias("v"))
    parts = tables.overwrite(profile.quantile_sketches(rows, "v", ["m"]), f"{folder}/q")
    found = profile.merged_quantiles(parts).first()
    assert (parts.count(), found.value_count) == (12, 60_000)
    for name, p in profile.PERCENTILES.items():
        assert abs(found[f"{name}_value"] / 59_999 - p) < 0.01
    keys = {"v": ["v"], "both": ["m", "v"], "m": ["m"]}
    stored = tables.overwrite(profile.key_sketches(rows, keys, ["m"]), f"{folder}/k")
    about = {r.candidate_key: r for r in profile.merged_key_counts(stored, list(keys)).collect()}
    exact = {r.candidate_key: r for r in profile.duplicate_keys(rows, keys).collect()}
    for name in keys:
        assert abs(about[name].about_distinct / exact[name].distinct_keys - 1) < 0.04
    assert profile.merged_key_counts(stored.where("false"), ["v"]).first().about_distinct == 0
    lines = tables.overwrite(rows, f"{folder}/rows")
    assert plan_of(profile.duplicate_keys(lines, keys)).count("FileScan") == 1


def test_date_dimension_has_no_default_member(spark):
    only = Dimension(
        date_dimension(days(spark, Calendar(dt.date(2024, 1, 1), dt.date(2024, 1, 1)))),
        "full_date",
        "date_sk",
    )
    dims = {**dimensions(spark), "dim_date": only}
    rows = build_fact(trip(spark, {}), dims, YEAR)
    assert rows.first().pickup_date_sk is None
    assert not checks.null_checks(rows, ["pickup_date_sk"]).first().passed


@pytest.mark.parametrize("ids", [[1, 1, 2], [0, 1], [None, 1]])
def test_a_lookup_whose_id_is_no_key_is_refused(spark, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "location_id int")
    with pytest.raises(ValueError):
        gold.require_keys(rows, "location_id")
    named = rows.withColumn("zone_name", F.lit("z"))
    with pytest.raises(ValueError):
        dimension(named, "location_id", "zone_sk", "zone_name", "none")
