"""Keyed upsert into a partitioned Parquet table: as a frame, and into a stored table by file."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import expressions as X
from strata.session import scratch_path
from strata.sources import snapshots, tables
from strata.sources.tables import in_partitions

ACTION = "_action"
CHANGED = ("inserted", "updated")
# Rows of a table partition that are merged in one bucket, and become one file.
ROWS_PER_BUCKET = 500_000


def _keys_match(keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"t.{key}"), F.col(f"s.{key}")) for key in keys]
    return X.all_of(t.eqNullSafe(s) if null_safe else t == s for t, s in pairs)


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    hash_column: str,
    version_column: str,
    null_safe: bool = True,
) -> DataFrame:
    """The merged rows, each with the action that made it.

    ``updated``: the key is on both sides, the hash differs and the source is newer;
    ``unchanged``: on both sides otherwise; ``inserted``: only in the source; ``kept``: only in
    the target. Both sides hold a key at most once (see ``dedup.latest_per_key``).

    ``null_safe=False`` compares keys with ``=``, so a row with a NULL key never finds its
    target row and is inserted again on every run.
    """
    columns = source.columns
    old = target.select(*columns).withColumn("_in_target", F.lit(True)).alias("t")
    new = source.withColumn("_in_source", F.lit(True)).alias("s")
    newer = (F.col(f"s.{hash_column}") != F.col(f"t.{hash_column}")) & (
        F.col(f"s.{version_column}") > F.col(f"t.{version_column}")
    )
    action = (
        F.when(F.col("_in_target").isNull(), "inserted")
        .when(F.col("_in_source").isNull(), "kept")
        .when(newer, "updated")
        .otherwise("unchanged")
    )
    from_source = F.col(ACTION).isin(*CHANGED)
    return (
        old.join(new, _keys_match(keys, null_safe), "full_outer")
        .withColumn(ACTION, action)
        .select(
            *[
                F.when(from_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
                for c in columns
            ],
            ACTION,
        )
    )


def action_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy(F.col(ACTION).alias("action")).agg(F.count("*").alias("row_count"))


def partitions_of(df: DataFrame, partition_by: Sequence[str]) -> list[tuple]:
    """The distinct partition values. These are table partitions (months), never row keys."""
    return [tuple(row) for row in df.select(*partition_by).distinct().collect()]


def require_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs twice: both rows would match the target row and multiply it."""
    twice = source.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    if not twice.isEmpty():
        raise ValueError(f"the source holds a key ({', '.join(keys)}) more than once")


def actions(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    hash_column: str,
    version_column: str,
    null_safe: bool = True,
) -> DataFrame:
    """Key, action and target file of every source row; only keys, hashes and versions are read.

    ``target`` is read from files. ``_file`` is the file that holds the row of the key, as
    ``_metadata.file_path`` spells it, and NULL for a new key.
    """
    narrow = [*keys, hash_column, version_column]
    new = source.select(*narrow).alias("s")
    old = target.select(*narrow, F.col("_metadata.file_path").alias("_file")).alias("t")
    newer = (F.col(f"s.{hash_column}") != F.col(f"t.{hash_column}")) & (
        F.col(f"s.{version_column}") > F.col(f"t.{version_column}")
    )
    action = F.when(F.col("_file").isNull(), "inserted").when(newer, "updated").otherwise("unchanged")
    found = new.join(old, _keys_match(keys, null_safe), "left")
    return found.select(*[F.col(f"s.{key}") for key in keys], action.alias(ACTION), "_file")


def packed(rows: DataFrame, hash_column: str, row_hash: Column | None) -> DataFrame:
    """The rows with a hash only where it is not what their columns give, so it is neither moved nor staged.

    A hash of 64 characters would be most of a narrow row. ``unpacked`` gives back every hash as it was.
    """
    if row_hash is None:
        return rows
    own = F.col(hash_column)
    return rows.withColumn(hash_column, F.when(~own.eqNullSafe(row_hash), F.struct(own.alias("kept"))))


def _hash_of(hash_column: str, row_hash: Column | None) -> Column:
    """The hash of a packed row."""
    own = F.col(hash_column)
    return own if row_hash is None else F.when(own.isNull(), row_hash).otherwise(own["kept"])


def unpacked(rows: DataFrame, hash_column: str, row_hash: Column | None) -> DataFrame:
    return rows.withColumn(hash_column, _hash_of(hash_column, row_hash))


def _dealt(rows: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """The rows shuffled once: all of a key together, and each table partition over as many buckets as it needs.

    Counted per table partition, so a busy month is dealt over several tasks, and a task writes few files.
    """
    spark = rows.sparkSession
    sizes = rows.groupBy(*partition_by).agg(F.count("*").alias("_buckets")).collect()
    fields = [T.StructField(f"_of_{c}", rows.schema[c].dataType) for c in partition_by]
    schema = T.StructType([*fields, T.StructField("_buckets", T.LongType())])
    listed = [(*row[:-1], -(-row[-1] // ROWS_PER_BUCKET)) for row in sizes]
    same = X.all_of(F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in partition_by)
    dealt = rows.join(F.broadcast(tables.inline_rows(spark, listed, schema)), same, "left")
    bucket = F.pmod(F.xxhash64(*keys), F.col("_buckets"))
    return dealt.select(*rows.columns, bucket.alias("_bucket")).repartition(*partition_by, "_bucket")


def _matched(
    rows: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    hash_column: str,
    version_column: str,
    null_safe: bool,
    row_hash: Column | None,
) -> DataFrame:
    """Packed rows of target and batch (``_new``), each with its action.

    Rows of the batch: ``inserted``, ``updated`` or ``unchanged``; of the target: ``kept`` (its key is not in the
    batch), ``matched`` (an unchanged key) or ``replaced``. ``twice``: the key is in the batch more than once, or
    matches several target rows.
    """
    # With plain equality a NULL key finds nothing: both sides stay apart.
    apart = F.lit(None).cast("boolean")
    if not null_safe:
        apart = F.when(reduce(or_, [F.col(key).isNull() for key in keys]), F.col("_new"))
    dealt = _dealt(rows, keys, partition_by).withColumns({"_hash": _hash_of(hash_column, row_hash), "_apart": apart})
    key = Window.partitionBy(*partition_by, "_bucket", *keys, "_apart")
    side = lambda new, c: F.max(F.when(F.col("_new") == new, F.col(c))).over(key)
    found = dealt.withColumns(
        {
            "_n_old": F.count_if(~F.col("_new")).over(key),
            "_n_new": F.count_if(F.col("_new")).over(key),
            "_newer": F.coalesce(
                (side(True, "_hash") != side(False, "_hash"))
                & (side(True, version_column) > side(False, version_column)),
                F.lit(False),
            ),
        }
    )
    twice = (F.col("_n_new") > 1) | ((F.col("_n_new") == 1) & (F.col("_n_old") > 1))
    action = (
        F.when(twice, "twice")
        .when(F.col("_new") & (F.col("_n_old") == 0), "inserted")
        .when(F.col("_new"), F.when(F.col("_newer"), "updated").otherwise("unchanged"))
        .when(F.col("_newer"), "replaced")
        .otherwise(F.when(F.col("_n_new") > 0, "matched").otherwise("kept"))
    )
    return found.select(*rows.columns, action.alias(ACTION))


def upsert(
    source: DataFrame,
    target: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    hash_column: str,
    version_column: str,
    null_safe: bool = True,
    stream: tuple[str, int] | None = None,
    row_hash: Column | None = None,
) -> DataFrame:
    """Merge ``source`` into the table at ``target``, a path or a catalog name; returns the action counts.

    ``partition_by`` must be a function of the key: of the target only the partitions the source
    touches are looked at. Their rows and the batch are shuffled once, by table partition and key, which
    tells the action of each row and so which *files* hold a row that changes. These files alone are
    written anew, without their old rows and with the new ones,
    and one commit swaps them (``snapshots``): a reader sees the table before or after, and a
    run that dies before its commit has changed nothing. A batch that changes nothing writes nothing.

    ``row_hash`` is the expression over the other columns that ``hash_column`` is made with, if known: a
    hash that equals it is computed where it is needed instead of being moved.

    The plan of ``source`` is run once, into a staged table. One writer at a time. ``stream`` (name and
    batch number) is kept with the commit, see ``snapshots.streams``; such a batch always commits.
    """
    spark = source.sparkSession
    path = snapshots.place(spark, target)
    based_on = snapshots.latest(spark, path)
    if based_on is None and not tables.path_exists(spark, path):
        counts = _first_load(source, path, keys, partition_by, stream, hash_column, row_hash)
    else:
        counts = _merge_files(
            source, path, keys, partition_by, hash_column, version_column, null_safe, based_on, stream, row_hash
        )
    if path != target:
        snapshots.publish(spark, target, path, source.columns)
    return counts


def _first_load(source, path, keys, partition_by, stream, hash_column, row_hash) -> DataFrame:
    """Written in place, then looked at, then committed: the source plan is run once.

    A commit of no files comes first, so files of a run that died here are never taken for a table.
    """
    spark = source.sparkSession
    empty = snapshots.commit(spark, path, snapshots.no_files(spark), None)
    rows = tables.rebalanced(packed(source, hash_column, row_hash), partition_by)
    files = snapshots.append_files(unpacked(rows, hash_column, row_hash), path, partition_by, spread=False)
    paths = [row.path for row in files.select("path").collect()]
    written = snapshots.read_files(spark, path, paths, source.schema)
    require_unique(written, keys)
    snapshots.commit(spark, path, files, empty, stream)
    return _summary(spark, {"inserted": written.count()})


def _merge_files(
    source, path, keys, partition_by, hash_column, version_column, null_safe, based_on, stream, row_hash
) -> DataFrame:
    spark, columns = source.sparkSession, source.columns
    batch = tables.overwrite(packed(source, hash_column, row_hash), scratch_path(spark, "upsert-batch"))
    current = tables.read(spark, path, source.schema)
    touched = in_partitions(current, partition_by, partitions_of(batch, partition_by))
    # A row names its file by number. The list of files is on the driver for the scan already.
    valid = snapshots.files(spark, path)
    numbered = [(row.file, i) for i, row in enumerate(valid.select("file").collect())]
    schema = T.StructType([T.StructField("_path", T.StringType()), T.StructField("_file", T.IntegerType())])
    numbers = tables.inline_rows(spark, numbered, schema)
    old = touched.select(*columns, F.col("_metadata.file_path").alias("_path"))
    old = packed(old.join(F.broadcast(numbers), "_path", "left"), hash_column, row_hash)
    new = batch.select(*columns, F.lit(None).cast("int").alias("_file"), F.lit(True).alias("_new"))
    rows = old.select(*columns, "_file", F.lit(False).alias("_new")).unionAll(new)
    found = _matched(rows, keys, partition_by, hash_column, version_column, null_safe, row_hash)
    # Staged as the table is parted, so the files that change are written from it without another shuffle.
    found = tables.overwrite(found, scratch_path(spark, "upsert-actions"), partition_by, spread=False)
    counts = {row.action: row.row_count for row in action_counts(found).collect()}
    if counts.get("twice"):
        raise ValueError(f"the source holds a key ({', '.join(keys)}) more than once")
    # Files, never rows: at most the file index of the table.
    replaced = found.where(F.col(ACTION) == "replaced").select("_file").distinct()
    stale = [row["_file"] for row in replaced.collect()]
    counts = {action: n for action, n in counts.items() if action not in ("matched", "replaced")}
    if any(counts.get(action) for action in CHANGED):
        rest = F.col(ACTION).isin("kept", "matched") & F.col("_file").isin(stale)
        rows = unpacked(found.where(F.col(ACTION).isin(*CHANGED) | rest), hash_column, row_hash)
        gone = tables.inline_rows(spark, [numbered[i] for i in stale], schema)
        valid = tables.overwrite(
            valid.join(F.broadcast(gone), valid["file"] == F.col("_path"), "left_anti"),
            scratch_path(spark, "upsert-files"),
        )
        added = snapshots.append_files(rows.select(*columns), path, partition_by, spread=False)
        valid = valid.unionByName(added)
    elif stream is None:
        return _summary(spark, counts)
    snapshots.commit(spark, path, valid, based_on, stream)
    return _summary(spark, counts)


def _summary(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    schema = T.StructType([T.StructField("action", T.StringType()), T.StructField("row_count", T.LongType())])
    return tables.inline_rows(spark, [(k, n) for k, n in sorted(counts.items()) if n], schema)
