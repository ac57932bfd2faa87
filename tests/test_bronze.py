import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from strata.catalogue import bindings, queries
from strata.operators import checks
from strata.plans import bronze
from strata.sources import landing, lookups, snapshots, tables
from strata.streaming import incremental
from strata.trips import LINEAGE_TYPES, ZONE_LOOKUP_COLUMNS


def land(folder, month, rows, name=None, **more):
    path = f"{folder}/landing dir+/2024/{month:02d}"
    os.makedirs(path, exist_ok=True)
    name = name or f"trips_2024-{month:02d}.parquet"
    data = {"id": list(range(rows)), "at": [dt.datetime(2024, month, 1)] * rows, **more}
    schema = pa.schema([("id", pa.int64()), ("at", pa.timestamp("us"))])
    for column, values in more.items():
        schema = schema.append(pa.field(column, pa.array(values).type))
    pq.write_table(pa.table(data, schema=schema), f"{path}/{name}")
    return f"{folder}/landing dir+"


def run(spark, folder, batch):
    return bronze.ingest(
        spark, f"{folder}/landing dir+", f"{folder}/b", f"{folder}/l", batch
    ).first()


def test_ingest_is_incremental_and_repeatable(spark, folder):
    land(folder, 1, 3)
    land(folder, 2, 4)
    assert run(spark, folder, "one").rows_loaded == 7
    again = run(spark, folder, "two")
    assert (again.files_loaded, again.rows_bronze, again.passed) == (0, 7, True)
    land(folder, 3, 5)
    third = run(spark, folder, "three")
    assert (third.files_loaded, third.rows_loaded, third.rows_bronze) == (1, 5, 12)
    rows = tables.read(spark, f"{folder}/b")
    assert rows_of(rows.groupBy("year", "month", "_ingestion_batch_id").count(), "*") == [
        (2024, 1, "one", 3), (2024, 2, "one", 4), (2024, 3, "three", 5),
    ]
    kinds = dict(rows.dtypes)
    assert all(kinds[c] == kind for c, kind in LINEAGE_TYPES.items())


def test_a_second_file_of_a_month_keeps_the_first(spark, folder):
    land(folder, 1, 3, "a_2024-01.parquet")
    run(spark, folder, "one")
    land(folder, 1, 2, "b_2024-01.parquet")
    assert run(spark, folder, "two").rows_bronze == 5


def test_crash_between_bronze_and_ledger_does_not_load_twice(spark, folder, monkeypatch):
    land(folder, 1, 3)
    run(spark, folder, "one")
    land(folder, 2, 4)

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(landing, "ledger_rows", die)
        with pytest.raises(RuntimeError):
            run(spark, folder, "two")
    assert tables.read(spark, f"{folder}/b").count() == 7  # loaded, not recorded
    result = run(spark, folder, "three")
    assert (result.rows_bronze, result.rows_ledger, result.passed) == (7, 7, True)


def test_an_empty_file_is_recorded_with_no_rows(spark, folder):
    land(folder, 1, 3)
    land(folder, 2, 0)
    result = run(spark, folder, "one")
    assert (result.files_loaded, result.rows_loaded) == (2, 3)
    assert run(spark, folder, "two").files_loaded == 0


def test_only_empty_files(spark, folder):
    land(folder, 1, 0)
    assert run(spark, folder, "one").rows_bronze == 0
    again = run(spark, folder, "two")
    assert (again.files_landed, again.files_loaded, again.passed) == (1, 0, True)


def test_a_new_column_is_kept(spark, folder):
    land(folder, 1, 2)
    land(folder, 2, 2, fee=[1.0, 2.0])
    run(spark, folder, "one")
    rows = tables.read(spark, f"{folder}/b", merge_schema=True)
    assert rows_of(rows, "month", "fee") == [(1, None), (1, None), (2, 1.0), (2, 2.0)]


def test_backfill_of_an_empty_ledger(spark, folder):
    base = land(folder, 1, 3)
    land(folder, 2, 4)
    run(spark, folder, "one")
    first = rows_of(tables.read(spark, f"{folder}/l"), "source_file", "file_size_bytes", "row_count")
    result = bronze.ingest(spark, base, f"{folder}/b", f"{folder}/new-ledger", "two").first()
    assert (result.files_loaded, result.passed) == (0, True)
    rebuilt = tables.read(spark, f"{folder}/new-ledger")
    assert rows_of(rebuilt, "source_file", "file_size_bytes", "row_count") == first
    assert rows_of(rebuilt, "ingestion_batch_id") == [("one",), ("one",)]


def test_backfill_fails_for_a_lost_file(spark, folder):
    base = land(folder, 1, 3)
    land(folder, 2, 4)
    run(spark, folder, "one")
    os.rename(f"{base}/2024/02/trips_2024-02.parquet", f"{base}/2024/02/trips.gone")
    with pytest.raises(FileNotFoundError):
        bronze.ingest(spark, base, f"{folder}/b", f"{folder}/new-ledger", "two")


def test_a_crash_before_the_commit_loads_nothing(spark, folder, monkeypatch):
    land(folder, 1, 3)
    run(spark, folder, "one")
    land(folder, 2, 4)

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "commit", die)
        with pytest.raises(RuntimeError):
            run(spark, folder, "two")
    assert tables.read(spark, f"{folder}/b").count() == 3  # written, not committed
    result = run(spark, folder, "three")
    assert (result.rows_loaded, result.rows_bronze, result.rows_ledger, result.passed) == (4, 7, 7, True)
    assert rows_of(tables.read(spark, f"{folder}/b").groupBy("_ingestion_batch_id").count(), "*") == [
        ("one", 3), ("three", 4),
    ]


def test_files_are_loaded_and_recorded_chunk_by_chunk(spark, folder, monkeypatch):
    monkeypatch.setattr(landing, "FILES_PER_WRITE", 2)
    for month in range(1, 6):
        land(folder, month, month)
    whole, seen = landing.load_chunk, []

    def stop_at_the_third(files, *args):
        seen.append(files.count())
        if len(seen) == 3:
            raise RuntimeError("lost")
        whole(files, *args)

    with monkeypatch.context() as patch:
        patch.setattr(landing, "load_chunk", stop_at_the_third)
        with pytest.raises(RuntimeError):
            run(spark, folder, "one")
    assert seen == [2, 2, 1]
    assert tables.read(spark, f"{folder}/l").count() == 4  # the first two chunks stay loaded
    result = run(spark, folder, "two")
    assert (result.files_loaded, result.rows_loaded, result.rows_bronze, result.passed) == (1, 5, 15, True)


def test_no_list_of_files_is_in_the_plan(spark, folder):
    base = land(folder, 1, 3)
    land(folder, 2, 3)
    (chunk,) = landing.chunks(landing.manifest(spark, base))
    rows = landing.chunk_rows(chunk, "b")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and "2024-01" not in plan and "SinglePartition" not in plan
    assert "Exchange hashpartitioning" not in plan_of(rows)


def test_backfill_refuses_a_part_of_a_file(spark, folder, monkeypatch):
    base = land(folder, 1, 3)
    whole = landing.with_lineage
    monkeypatch.setattr(landing, "with_lineage", lambda *args: whole(*args).where("id > 0"))
    run(spark, folder, "one")
    with pytest.raises(ValueError, match="2 of 3 rows"):
        bronze.ingest(spark, base, f"{folder}/b", f"{folder}/new-ledger", "two")


def test_each_file_has_one_status(spark, folder):
    base = land(folder, 1, 3)
    for month in (2, 3, 4, 5):
        land(folder, month, 4)
    run(spark, folder, "one")
    land(folder, 1, 30_000)
    land(folder, 6, 1)
    land(folder, 7, 1, "other.parquet")
    os.rename(f"{base}/2024/03/trips_2024-03.parquet", f"{folder}/gone")
    book = tables.read(spark, f"{folder}/l").where("source_file NOT LIKE '%2024-04%'")
    rows = tables.read(spark, f"{folder}/b").where("NOT (month = 5 AND id = 0)")
    files = landing.reconcile(landing.listing(spark, base), book, rows, [(2024, 1), (2024, 9)])
    assert rows_of(files, "month", "status", "ledger_rows", "bronze_rows") == sorted([
        (1, "size changed", 3, 3), (2, "loaded", 4, 4), (3, "lost", 4, 4), (4, "not recorded", None, 4),
        (5, "rows differ", 4, 3), (6, "pending", None, None), (None, "no month", None, None),
        (9, "month missing", None, None),
    ], key=repr)
    failed = {r.check for r in checks.failed(bronze.file_checks(files)).collect()}
    assert failed == {f"files: {s}" for s in ("size changed", "lost", "not recorded", "rows differ", "month missing")}


def test_manifest_skips_files_without_a_month_and_opens_no_file(spark, folder):
    base = land(folder, 1, 3)
    land(folder, 1, 3, "other.parquet")
    files = landing.manifest(spark, base)
    assert rows_of(files, "year", "month") == [(2024, 1)]
    assert "content" not in plan_of(files)


def test_bronze_checks(spark, folder):
    land(folder, 1, 3)
    run(spark, folder, "one")
    report = bronze.validate(
        spark, f"{folder}/b", f"{folder}/l", {"year": "int", "month": "string"}, ("at", "x"), ("at",)
    )
    failed = {r.check for r in checks.failed(report).collect()}
    assert failed == {"column month", "column x"}
    more = bronze.validate(
        spark, f"{folder}/b", f"{folder}/l", {}, ("at",), ("at",),
        f"{folder}/landing dir+", [(2024, 1), (2024, 2)], ("at", 2024, (2, 3)),
    )
    assert {r.check for r in checks.failed(more).collect()} == {"files: month missing"}
    assert ("at in range", "3", "warn") in {(r.check, r.actual, r.severity) for r in more.collect()}
    with pytest.raises(AssertionError):
        checks.require(report)


def test_stream_loads_what_landed_since(spark, folder):
    base = land(folder, 1, 3)
    args = (base, "id bigint, at timestamp_ntz", f"{folder}/b", f"{folder}/l", f"{folder}/cp")
    incremental.load_available(spark, *args).awaitTermination()
    land(folder, 2, 4)
    incremental.load_available(spark, *args).awaitTermination()
    incremental.load_available(spark, *args).awaitTermination()
    rows = tables.read(spark, f"{folder}/b")
    assert rows_of(rows.groupBy("month").count(), "month", "count") == [(1, 3), (2, 4)]
    assert bronze.reconcile(spark, f"{folder}/b", f"{folder}/l").first().passed
    # The batch load finds the same files in the ledger.
    assert run(spark, folder, "batch").files_loaded == 0


def test_lookup_from_file_else_table_else_nothing(spark, folder):
    path = f"{folder}/zones.csv"
    with open(path, "w") as out:
        out.write("LocationID,Zone,Borough,service_zone\n1,Airport,EWR,EWR\nx,Bad,,\n")
    lookup, source = lookups.first_available(spark, path, f"{folder}/none", ZONE_LOOKUP_COLUMNS)
    assert source == path
    assert rows_of(lookup, "location_id", "zone_name") == [(1, "Airport"), (None, "Bad")]
    raw = spark.read.option("header", True).csv(path)
    tables.overwrite(raw, f"{folder}/table")
    gone = f"{folder}/gone.csv"
    lookup, source = lookups.first_available(spark, gone, f"{folder}/table", ZONE_LOOKUP_COLUMNS)
    assert source == f"{folder}/table" and lookup.count() == 2
    assert lookups.first_available(spark, gone, f"{folder}/none", ZONE_LOOKUP_COLUMNS) == (
        None,
        None,
    )
    assert "no lookup at" in lookups.skipped(spark, "zones", gone, "t").first().message


def test_catalog_tables(spark):
    tables.ensure_database(spark, "strata_test")
    rows = spark.range(4).withColumn("p", F.col("id") % 2)
    tables.overwrite(rows, "strata_test.t", ["p"])
    tables.overwrite_partitions(
        spark.createDataFrame([(9, 1)], "id bigint, p bigint"), "strata_test.t", ["p"]
    )
    assert rows_of(spark.table("strata_test.t"), "id") == [(0,), (2,), (9,)]
    tables.append(spark.createDataFrame([(7, 3)], "id bigint, p bigint"), "strata_test.t", ["p"])
    assert tables.read(spark, "strata_test.t").count() == 4
    spark.sql("DROP DATABASE strata_test CASCADE")


def test_files_left_out_and_months_missing_fail_the_run(spark, folder):
    base = land(folder, 1, 3)
    land(folder, 2, 4, "trips_202402.parquet")
    land(folder, 4, 2, "trips_2024-04.PARQUET")
    result = run(spark, folder, "one")
    assert (result.files_landed, result.files_unmatched, result.passed) == (3, 2, False)
    args = (spark, base, f"{folder}/b2", f"{folder}/l2", "one", landing.MONTH_IN_PATH)
    assert bronze.ingest(*args, [(2024, 1), (2024, 3)]).first().months_missing == 1


def test_ledger_counts_the_landed_files_not_bronze(spark, folder, monkeypatch):
    land(folder, 1, 3)
    whole = landing.with_lineage

    def lossy(*args):
        return whole(*args).where("id > 0")

    monkeypatch.setattr(landing, "with_lineage", lossy)
    result = run(spark, folder, "one")
    assert (result.rows_ledger, result.rows_bronze, result.passed) == (3, 2, False)


def test_a_repeated_micro_batch_of_an_upsert_is_skipped(spark, folder, monkeypatch):
    schema = "k int, v string, h string, ts int, year int, month int"
    spark.createDataFrame([(1, "a", "h1", 1, 2024, 1), (1, "b", "h2", 2, 2024, 1)], schema).write.parquet(f"{folder}/in")
    source = spark.readStream.schema(schema).parquet(f"{folder}/in")

    def go():
        args = (source, f"{folder}/t", f"{folder}/cp", ["k"], ["year", "month"], "h", "ts")
        incremental.upsert_available(*args).awaitTermination()

    whole = incremental.upsert.upsert

    def die_after(*args, **kwargs):
        whole(*args, **kwargs)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(incremental.upsert, "upsert", die_after)
        with pytest.raises(Exception, match="lost"):
            go()
    commit = snapshots.latest(spark, f"{folder}/t")
    go()  # Spark runs the batch again, as it was not marked as done
    assert snapshots.latest(spark, f"{folder}/t") == commit
    spark.createDataFrame([(1, "c", "h3", 3, 2024, 1), (2, "x", "h", 1, 2024, 2)], schema).write.mode("append").parquet(f"{folder}/in")
    go()
    assert rows_of(tables.read(spark, f"{folder}/t"), "k", "v") == [(1, "c"), (2, "x")]


def test_file_status_tells_the_state_of_every_file(spark):
    files = spark.createDataFrame(
        [("a", 5, 2024, 1), ("b", 6, 2024, 2), ("c", 7, 2024, 3), ("d", 8, 2024, 4)], landing.FILE_SCHEMA
    )
    book = spark.createDataFrame(
        [
            ("a", 5, dt.datetime(2024, 5, 1), "one", 1),
            ("b", 6, dt.datetime(2024, 5, 1), "one", 1),
            ("b", 9, dt.datetime(2024, 5, 2), "two", 1),
            ("d", None, dt.datetime(2024, 5, 1), "one", 1),
        ],
        landing.LEDGER_SCHEMA,
    )
    found = landing.file_status(files, book)
    assert found.columns == [*files.columns, "status"]
    assert rows_of(found, "source_file", "status") == [
        ("a", "loaded"), ("b", "size changed"), ("c", "pending"), ("d", "loaded"),
    ]


def test_pending_files_reports_every_month(spark, folder):
    orders = [(i, 1, "O", 1.0, at, "1-URGENT") for i, at in enumerate(
        [dt.datetime(1995, 3, 1), dt.datetime(1996, 1, 5), dt.datetime(1996, 2, 5), dt.datetime(1997, 1, 1)]
    )]
    spark.createDataFrame(orders, bindings.SCHEMAS["orders"]).write.parquet(f"{folder}/orders.parquet")
    assert rows_of(queries.pending_files(spark, folder), "year", "month", "status", "months") == [
        (1995, 3, "loaded", 1), (1996, 1, "pending", 1), (1996, 2, "pending", 1), (1997, 1, "loaded", 1),
    ]


def test_the_stream_lands_a_load_without_bringing_it_into_one_task(spark, folder, monkeypatch):
    at = dt.datetime(1995, 3, 1)
    orders = [(i, 1, "O", 1.0, at, "1-URGENT") for i in range(4)]
    lines = [
        (i, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", dt.datetime(year, 5, 1)) for i in range(4) for year in (1996, 2000)
    ]
    spark.createDataFrame(orders, bindings.SCHEMAS["orders"]).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, bindings.SCHEMAS["lineitem"]).write.parquet(f"{folder}/lineitem.parquet")
    plans, append = [], tables.append

    def record(df, target, partition_by=()):
        if target.endswith("/landing"):
            plans.append(plan_of(df))
        append(df, target, partition_by)

    monkeypatch.setattr(tables, "append", record)
    result = queries.stream_upsert(spark, folder)
    assert rows_of(result, "l_orderkey", "l_shipdate") == [(i, dt.datetime(2000, 5, 1)) for i in range(4)]
    assert len(plans) == 2 and not any("SinglePartition" in p or "REPARTITION_BY_NUM" in p for p in plans)
