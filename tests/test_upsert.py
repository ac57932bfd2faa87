import pytest
from helpers import plan_of, rows_of, same

from pyspark.sql import functions as F

from strata.operators import upsert
from strata.sources import snapshots, tables

SCHEMA = "k int, v string, h string, ts int, year int, month int"
ARGS = (["k"], ["year", "month"], "h", "ts")


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


FIRST = (
    (1, "a", "h1", 1, 2024, 1),
    (2, "b", "h2", 1, 2024, 1),
    (3, "c", "h3", 1, 2024, 2),
    (4, "d", "h4", 5, 2024, 2),
    (None, "n", "hn", 1, None, None),
)
SECOND = (
    (1, "a", "h1", 2, 2024, 1),  # unchanged
    (2, "B", "H2", 2, 2024, 1),  # changed and newer
    (4, "D", "H4", 4, 2024, 2),  # changed but older
    (5, "e", "h5", 2, 2024, 3),  # new
    (None, "N", "HN", 2, None, None),
)
MERGED = [
    (1, "a", 1), (2, "B", 2), (3, "c", 1), (4, "d", 5), (5, "e", 2), (None, "N", 2),
]


def counts(df):
    return {r.action: r.row_count for r in df.collect()}


def test_upsert_and_rerun(spark, folder):
    target = f"{folder}/t"
    assert counts(upsert.upsert(batch(spark, *FIRST), target, *ARGS)) == {"inserted": 5}
    second = batch(spark, *SECOND)
    assert counts(upsert.upsert(second, target, *ARGS)) == {
        "inserted": 1, "updated": 2, "unchanged": 2, "kept": 1,
    }
    result = tables.read(spark, target)
    assert rows_of(result, "k", "v", "ts") == sorted(MERGED, key=repr)
    assert counts(upsert.upsert(second, target, *ARGS)) == {"unchanged": 5, "kept": 1}
    assert same(result, tables.read(spark, target))


def test_plain_equality_inserts_null_keys_again(spark, folder):
    target = f"{folder}/t"
    rows = batch(spark, (None, "n", "hn", 1, 2024, 1), (1, "a", "h1", 1, 2024, 1))
    upsert.upsert(rows, target, *ARGS)
    upsert.upsert(rows, target, *ARGS, null_safe=False)
    assert rows_of(tables.read(spark, target), "k") == [(1,), (None,), (None,)]


def test_only_touched_partitions_are_read_and_rewritten(spark, folder):
    target = f"{folder}/t"
    upsert.upsert(batch(spark, *FIRST), target, *ARGS)

    def files(rows):
        return {r[0] for r in rows.select("_metadata.file_name").collect()}

    stored = tables.read(spark, target)
    january, february = files(stored.where("month = 1")), files(stored.where("month = 2"))
    source = batch(spark, (1, "A", "H1", 9, 2024, 1))
    months = upsert.partitions_of(source, ["year", "month"])
    assert files(upsert.in_partitions(stored, ["year", "month"], months)) == january
    assert "PartitionFilters: [(year" in plan_of(
        upsert.in_partitions(stored, ["year", "month"], months)
    )
    upsert.upsert(source, target, *ARGS)
    after = tables.read(spark, target)
    assert files(after.where("month = 2")) == february
    assert not files(after.where("month = 1")) & january
    assert after.count() == 5


def data_files(spark, target):
    return {r.path for r in snapshots.listed(spark, target).collect()}


def test_a_run_that_dies_before_its_commit_changes_nothing(spark, folder, monkeypatch):
    target = f"{folder}/t"
    upsert.upsert(batch(spark, *FIRST), target, *ARGS)
    before = rows_of(tables.read(spark, target), "k", "v", "ts")

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "commit", die)
        with pytest.raises(RuntimeError):
            upsert.upsert(batch(spark, *SECOND), target, *ARGS)
    # Its files are there, but no reader takes them for the table.
    assert len(data_files(spark, target)) > snapshots.files(spark, target).count()
    assert rows_of(tables.read(spark, target), "k", "v", "ts") == before
    upsert.upsert(batch(spark, *SECOND), target, *ARGS)
    assert rows_of(tables.read(spark, target), "k", "v", "ts") == sorted(MERGED, key=repr)
    snapshots.vacuum(spark, target, keep=1)
    assert data_files(spark, target) == {r.path for r in snapshots.files(spark, target).collect()}
    assert rows_of(tables.read(spark, target), "k", "v", "ts") == sorted(MERGED, key=repr)


def test_a_first_load_that_dies_leaves_no_table_to_merge_with(spark, folder, monkeypatch):
    target, twice = f"{folder}/t", batch(spark, *FIRST, FIRST[0])
    with pytest.raises(ValueError):
        upsert.upsert(twice, target, *ARGS)
    assert counts(upsert.upsert(batch(spark, *FIRST), target, *ARGS)) == {"inserted": 5}
    assert tables.read(spark, target).count() == 5


def test_an_unchanged_rerun_writes_nothing(spark, folder):
    target = f"{folder}/t"
    upsert.upsert(batch(spark, *FIRST), target, *ARGS)
    commit, files = snapshots.latest(spark, target), data_files(spark, target)
    upsert.upsert(batch(spark, *FIRST), target, *ARGS)
    assert (snapshots.latest(spark, target), data_files(spark, target)) == (commit, files)


def test_only_the_files_that_change_are_rewritten(spark, folder):
    """Two files in one month; the change is in one of them."""
    target = f"{folder}/t"
    upsert.upsert(batch(spark, (1, "a", "h1", 1, 2024, 1)), target, *ARGS)
    upsert.upsert(batch(spark, (2, "b", "h2", 1, 2024, 1)), target, *ARGS)
    first = {r.k: r.f for r in tables.read(spark, target).select("k", F.col("_metadata.file_path").alias("f")).collect()}
    assert len(set(first.values())) == 2
    upsert.upsert(batch(spark, (1, "A", "H1", 2, 2024, 1)), target, *ARGS)
    now = {r.k: r.f for r in tables.read(spark, target).select("k", F.col("_metadata.file_path").alias("f")).collect()}
    assert now[2] == first[2] and now[1] != first[1]
    assert rows_of(tables.read(spark, target), "k", "v") == [(1, "A"), (2, "b")]


def test_the_join_that_finds_the_files_reads_keys_hashes_and_versions_only(spark, folder):
    target = f"{folder}/t"
    upsert.upsert(batch(spark, *FIRST), target, *ARGS)
    plan = plan_of(upsert.actions(tables.read(spark, target), batch(spark, *SECOND), ["k"], "h", "ts"))
    assert "ReadSchema: struct<k:int,h:string,ts:int>" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_reader_sees_one_commit_while_another_run_commits(spark, folder):
    target = f"{folder}/t"
    upsert.upsert(batch(spark, *FIRST), target, *ARGS)
    reader = tables.read(spark, target)
    upsert.upsert(batch(spark, *SECOND), target, *ARGS)
    assert rows_of(reader, "k", "v") == sorted([r[:2] for r in FIRST], key=repr)
    assert rows_of(tables.read(spark, target), "k", "v", "ts") == sorted(MERGED, key=repr)
    with pytest.raises(RuntimeError):  # a run that began before the last commit
        snapshots.commit(spark, target, snapshots.files(spark, target), None)


def test_a_plain_table_becomes_one_with_commits(spark, folder):
    target = f"{folder}/t"
    tables.overwrite(batch(spark, *FIRST), target, ["year", "month"])
    assert counts(upsert.upsert(batch(spark, *SECOND), target, *ARGS))["updated"] == 2
    assert rows_of(tables.read(spark, target), "k", "v", "ts") == sorted(MERGED, key=repr)


def test_catalog_name(spark):
    tables.ensure_database(spark, "strata_upsert")
    name = "strata_upsert.lines"
    try:
        assert counts(upsert.upsert(batch(spark, *FIRST), name, *ARGS)) == {"inserted": 5}
        assert counts(upsert.upsert(batch(spark, *SECOND), name, *ARGS))["updated"] == 2
        for rows in (tables.read(spark, name), spark.table(name), spark.sql(f"SELECT * FROM {name}")):
            assert rows_of(rows, "k", "v", "ts") == sorted(MERGED, key=repr)
        commit = snapshots.latest(spark, snapshots.location(spark, name))
        assert counts(upsert.upsert(batch(spark, *SECOND), name, *ARGS)) == {"unchanged": 5, "kept": 1}
        assert snapshots.latest(spark, snapshots.location(spark, name)) == commit
        tables.overwrite(batch(spark, *FIRST), "strata_upsert.plain")
        with pytest.raises(ValueError):
            upsert.upsert(batch(spark, *SECOND), "strata_upsert.plain", *ARGS)
    finally:
        path = snapshots.location(spark, name)
        spark.sql("DROP DATABASE strata_upsert CASCADE")
        tables.drop_path(spark, path)


def test_the_null_safe_join_is_an_equi_join(spark):
    merged = upsert.merge(batch(spark, *FIRST), batch(spark, *SECOND), ["k"], "h", "ts")
    plan = plan_of(merged)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_source_with_a_key_twice_is_refused(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    upsert.require_unique(rows.dropDuplicates(["k"]), ["k"])
    with pytest.raises(ValueError):
        upsert.require_unique(rows, ["k"])


def written_plans(monkeypatch):
    """The plans of all frames written from here on."""
    plans, writer = [], tables._writer

    def record(df, mode, partition_by):
        plans.append(plan_of(df))
        return writer(df, mode, partition_by)

    monkeypatch.setattr(tables, "_writer", record)
    return plans


def test_a_merge_shuffles_its_rows_once(spark, folder, monkeypatch):
    target = f"{folder}/t"
    upsert.upsert(batch(spark, *FIRST), target, *ARGS)
    plans = written_plans(monkeypatch)
    upsert.upsert(batch(spark, *SECOND), target, *ARGS)
    assert sum(plan.count("Exchange hashpartitioning") for plan in plans) == 1
    assert not any("SortMergeJoin" in plan or "ShuffledHashJoin" in plan for plan in plans)
    assert rows_of(tables.read(spark, target), "k", "v", "ts") == sorted(MERGED, key=repr)


def test_a_known_hash_is_not_shuffled_and_any_other_is_kept(spark, folder, monkeypatch):
    row_hash = F.sha2("v", 256)
    own = lambda rows: rows.withColumn("h", F.when(F.col("k") == 3, F.col("h")).otherwise(row_hash))
    plain, packed = f"{folder}/plain", f"{folder}/packed"
    plans = written_plans(monkeypatch)
    for rows in (FIRST, SECOND):
        upsert.upsert(own(batch(spark, *rows)), plain, *ARGS)
        upsert.upsert(batch(spark, *rows).withColumn("h", row_hash), packed, *ARGS, row_hash=row_hash)
        other = own(batch(spark, *rows))
        upsert.upsert(other, f"{folder}/other", *ARGS, row_hash=row_hash)
    assert same(tables.read(spark, plain), tables.read(spark, f"{folder}/other"))
    assert rows_of(tables.read(spark, f"{folder}/other").where("k = 3"), "h") == [("h3",)]
    assert rows_of(tables.read(spark, packed), "k", "v", "ts") == sorted(MERGED, key=repr)
    assert tables.read(spark, packed).where(~F.col("h").eqNullSafe(row_hash)).isEmpty()


def test_a_busy_table_partition_is_dealt_over_several_buckets(spark, folder, monkeypatch):
    monkeypatch.setattr(upsert, "ROWS_PER_BUCKET", 10)
    target = f"{folder}/t"
    rows = [(i, "a", f"h{i % 7}", 1, 2024, 1) for i in range(100)]
    upsert.upsert(batch(spark, *rows), target, *ARGS)
    newer = batch(spark, *[(i, "b", f"h{i % 5}", 2, 2024, 1) for i in range(50, 120)])
    assert counts(upsert.upsert(newer, target, *ARGS)) == {
        "inserted": 20, "updated": sum(i % 7 != i % 5 for i in range(50, 100)),
        "unchanged": sum(i % 7 == i % 5 for i in range(50, 100)), "kept": 50,
    }
    stored = tables.read(spark, target)
    assert stored.count() == stored.select("k").distinct().count() == 120
    with pytest.raises(ValueError):
        upsert.upsert(newer.unionAll(newer), target, *ARGS)
