import datetime as dt

import pytest
from helpers import at, plan_of, raw_trips, rows_of, same
from pyspark.sql import functions as F

from strata import trips
from strata.catalogue import bindings
from strata.operators import dedup, rules
from strata.plans import silver
from strata.sources import tables

NOW = "2024-07-01 00:00:00"


def normalized(spark, *changes):
    return silver.normalized_trips(raw_trips(spark, *changes), at(NOW))


def failures(spark, **change):
    rows = rules.validate(normalized(spark, change), trips.trip_rules())
    return rows.first()[rules.FAILURES]


def test_normalize_renames_casts_and_measures(spark):
    row = normalized(spark, {"passenger_count": 2.9, "RatecodeID": None}).first()
    assert row.passenger_count == 2  # truncated
    assert row.rate_code_id is None
    assert row.trip_duration_minutes == 30.0
    assert (row.year, row.month) == (2024, 3)
    assert len(normalized(spark, {}).columns) == 24


def test_bad_number_becomes_null_instead_of_an_error(spark):
    assert normalized(spark, {"passenger_count": float("nan")}).first().passenger_count is None


@pytest.mark.parametrize(
    "change, code",
    [
        ({"passenger_count": float("nan")}, "invalid_passenger_count_cast"),
        ({"passenger_count": 1e10}, "invalid_passenger_count_cast"),
        ({"RatecodeID": -1e300}, "invalid_rate_code_id_cast"),
        ({"payment_type": 2**40}, "invalid_payment_type_cast"),
    ],
)
def test_a_value_lost_in_a_cast_fails_its_row(spark, folder, change, code):
    target = silver.SilverTables(f"{folder}/clean", f"{folder}/bad", f"{folder}/metrics")
    rows = raw_trips(spark, {}, change, {"RatecodeID": None, "passenger_count": None, "VendorID": 2})
    ran = silver.run(rows, target, "trips", load_time=at(NOW)).first()
    assert (ran.rows_clean, ran.rows_quarantined, ran.rules_failed) == (2, 1, {code: 1})
    bad = tables.read(spark, target.quarantine)
    assert rows_of(bad, rules.FAILURES) == [([code],)]
    assert not [c for c in (*bad.columns, *tables.read(spark, target.clean).columns) if "_lost_" in c]


@pytest.mark.parametrize(
    "change, expected",
    [
        ({}, []),
        ({"fare_amount": 500.0}, []),
        ({"fare_amount": 500.01}, ["invalid_fare_amount"]),
        ({"fare_amount": 0.0}, ["invalid_fare_amount"]),
        ({"fare_amount": None}, []),
        ({"trip_distance": 200.0}, []),
        ({"trip_distance": 200.01}, ["invalid_trip_distance"]),
        ({"trip_distance": 0.0}, ["invalid_trip_distance"]),
        ({"passenger_count": 6.0}, []),
        ({"passenger_count": 7.0}, ["invalid_passenger_count"]),
        ({"passenger_count": 0.0}, ["invalid_passenger_count"]),
        ({"passenger_count": None}, []),
        ({"tpep_dropoff_datetime": dt.datetime(2024, 3, 1, 8, 0)}, ["invalid_datetime_order"]),
        # A negative duration breaks the order rule alone.
        ({"tpep_dropoff_datetime": dt.datetime(2024, 3, 1, 7, 0)}, ["invalid_datetime_order"]),
        ({"tpep_dropoff_datetime": dt.datetime(2024, 3, 1, 11, 0)}, []),
        ({"tpep_dropoff_datetime": dt.datetime(2024, 3, 1, 11, 0, 1)}, ["invalid_trip_duration"]),
        ({"tpep_pickup_datetime": None}, []),
        ({"total_amount": 0.0}, ["invalid_total_amount"]),
        ({"tip_amount": 0.0}, []),
        ({"tip_amount": -0.01}, ["invalid_tip_amount"]),
        ({"tolls_amount": -1.0}, ["invalid_tolls_amount"]),
        (
            {"fare_amount": -1.0, "total_amount": -1.0, "tip_amount": -1.0},
            ["invalid_fare_amount", "invalid_total_amount", "invalid_tip_amount"],
        ),
    ],
)
def test_rule_bounds(spark, change, expected):
    assert failures(spark, **change) == expected


def test_split_is_complete_and_flags_are_never_null(spark):
    rows = normalized(
        spark, {}, {"fare_amount": None}, {"fare_amount": -1.0}, {"tpep_pickup_datetime": None}
    )
    checks = trips.trip_rules()
    assert rules.clean(rows, checks).count() == 3
    rejected = rules.quarantine(rows, checks)
    assert rows_of(rejected, rules.FAILURES) == [(["invalid_fare_amount"],)]
    flagged = rules.validate(rows, checks)
    assert flagged.where(" OR ".join(f"{r.flag} IS NULL" for r in checks)).isEmpty()


def test_rule_filter_reaches_the_scan(spark, folder):
    stored = tables.overwrite(normalized(spark, {}), f"{folder}/rows")
    plan = rules.clean(stored, trips.trip_rules())
    assert "LessThanOrEqual(fare_amount,500" in plan._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_settles_ties_and_groups_null_keys(spark):
    rows = spark.createDataFrame(
        [
            (1, 10, "b"),
            (1, 10, "a"),
            (1, 9, "z"),
            (None, 1, "x"),
            (None, 2, "y"),
            (2, None, "n"),
        ],
        "k int, v int, t string",
    )
    kept = dedup.latest_per_key(rows, ["k"], "v")
    assert rows_of(kept, "k", "v", "t") == [(1, 10, "a"), (2, None, "n"), (None, 2, "y")]
    again = dedup.latest_per_key(rows.orderBy(F.desc("t")).repartition(3), ["k"], "v")
    assert same(kept, again)


def test_latest_per_key_needs_its_order_column(spark):
    with pytest.raises(ValueError):
        dedup.latest_per_key(spark.range(1), ["id"], "loaded_at")


def test_a_hot_key_shrinks_before_the_shuffle(spark):
    rows = spark.range(100).selectExpr("id % 2 AS k", "id AS v")
    plan = plan_of(dedup.latest_per_key(rows, ["k"], "v"))
    before_exchange = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_row_hash_ignores_lineage_and_spells_nulls(spark):
    rows = silver.with_row_hash(
        normalized(spark, {"_source_file": "a"}, {"_source_file": "b"}, {"Airport_fee": 0.0})
    )
    hashes = [r[trips.ROW_HASH] for r in rows.collect()]
    assert hashes[0] == hashes[1] != hashes[2]


def test_run_writes_all_tables_and_repeats_without_change(spark, folder):
    bronze = raw_trips(
        spark,
        {},
        {},  # exact duplicate
        {"tip_amount": 3.0, "VendorID": 2},
        {"fare_amount": -1.0, "total_amount": -1.0},
        {"fare_amount": -2.0},
        {
            "tpep_pickup_datetime": dt.datetime(2024, 2, 29, 23, 30),
            "tpep_dropoff_datetime": dt.datetime(2024, 3, 1, 0, 30),
            "DOLocationID": None,
        },
    )
    target = silver.SilverTables(f"{folder}/clean", f"{folder}/bad", f"{folder}/metrics")
    first = silver.run(bronze, target, "trips", load_time=at(NOW)).first()
    assert (first.rows_in, first.rows_clean, first.rows_quarantined, first.rows_deduped) == (
        6, 3, 2, 1,
    )
    assert first.rules_failed == {"invalid_fare_amount": 2, "invalid_total_amount": 1}
    before = tables.read(spark, target.clean).collect()
    second = silver.run(bronze, target, "trips", load_time=at("2024-07-02 00:00:00")).first()
    assert sorted(map(repr, before)) == sorted(
        map(repr, tables.read(spark, target.clean).collect())
    )
    assert second.rows_clean == 3 and second.run_id != first.run_id
    assert tables.read(spark, target.metrics).count() == 2
    assert tables.read(spark, target.quarantine).count() == 2


def test_a_changed_row_replaces_the_old_one(spark, folder):
    target = silver.SilverTables(f"{folder}/clean", f"{folder}/bad", f"{folder}/metrics")
    silver.run(raw_trips(spark, {}), target, "trips", load_time=at(NOW))
    changed = raw_trips(spark, {"tip_amount": 9.0})
    silver.run(changed, target, "trips", load_time=at("2024-06-01 00:00:00"))  # older: ignored
    assert tables.read(spark, target.clean).first().tip_amount == 2.0
    silver.run(changed, target, "trips", load_time=at("2024-08-01 00:00:00"))
    assert rows_of(tables.read(spark, target.clean), "tip_amount") == [(9.0,)]


def test_a_run_evaluates_bronze_once(spark, folder):
    """Every bronze row raises a counter when it is read; three evaluations counted it three times."""
    read = spark.sparkContext.accumulator(0)
    kinds = raw_trips(spark, {}, {"fare_amount": -1.0}, {}).schema

    def seen(parts):
        for part in parts:
            read.add(part.num_rows)
            yield part

    bronze = raw_trips(spark, {}, {"fare_amount": -1.0}, {}).coalesce(1).mapInArrow(seen, kinds)
    target = silver.SilverTables(f"{folder}/clean", f"{folder}/bad", f"{folder}/metrics")
    ran = silver.run(bronze, target, "trips", load_time=at(NOW)).first()
    assert (ran.rows_in, ran.rows_clean, ran.rows_quarantined, ran.rows_deduped) == (3, 1, 1, 1)
    assert read.value == 3
    assert tables.read(spark, target.quarantine).first().validation_failures == ["invalid_fare_amount"]


def test_the_order_lines_of_the_trips_are_joined_with_orders_that_know_their_customer(spark, folder):
    """The join with customers is below the one with order lines, which would else be shuffled by customer too."""
    for name in ("lineitem", "orders", "supplier", "customer"):
        spark.createDataFrame([], bindings.SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet")
    plan = bindings.order_trips(spark, folder)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at_join = next(i for i, line in enumerate(plan) if "Join Inner" in line and "o_custkey" in line)
    below = [line for line in plan[at_join + 1 :] if depth(line) > depth(plan[at_join])]
    assert any("customer" in line or "c_custkey" in line for line in below)
    assert not any("l_orderkey" in line for line in below)
