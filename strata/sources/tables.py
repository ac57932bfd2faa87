"""Tables by path (``/a/b``, ``s3://...``) or by catalog name (``db.table``), stored as Parquet.

A path table with a commit list (``snapshots``) is read as of its newest commit.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.functions import expressions as X


# Row hashes are hex digits, which snappy leaves at a byte each and zstd at half of that.
COMPRESSION = "zstd"
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def is_path(target: str) -> bool:
    return "/" in target


def hadoop_path(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds anything but hidden files (a failed first write leaves only those)."""
    files, path = hadoop_path(spark, path)
    if not files.exists(path):
        return False
    return any(entry.getPath().getName()[0] not in "._" for entry in files.listStatus(path))


def file_exists(spark: SparkSession, path: str) -> bool:
    files, path = hadoop_path(spark, path)
    return files.exists(path)


def drop_path(spark: SparkSession, path: str) -> None:
    files, path = hadoop_path(spark, path)
    files.delete(path, True)


def exists(spark: SparkSession, target: str) -> bool:
    return path_exists(spark, target) if is_path(target) else spark.catalog.tableExists(target)


def read(
    spark: SparkSession,
    target: str,
    schema: T.StructType | str | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """The table; one with a commit list as of its newest commit.

    For a path table, a known ``schema`` saves the job that looks for it.

    ``merge_schema`` is for files that may differ in columns. It reads the footer of every file
    first (as a job), so it is for bronze only: all other tables are written with one schema.
    """
    path = target if is_path(target) else snapshots.location(spark, target)
    if path is not None and (commit := snapshots.latest(spark, path)) is not None:
        return snapshots.read(spark, path, schema, commit, merge_schema)
    if not is_path(target):
        return spark.table(target)
    if schema is not None:
        return spark.read.schema(schema).parquet(target)
    return spark.read.option("mergeSchema", merge_schema).parquet(target)


def read_or_empty(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    if exists(spark, target):
        return read(spark, target, schema)
    return inline_rows(spark, [], schema)


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few rows held in the plan itself, so that Spark knows their size and needs no scan."""
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrow = to_arrow_schema(schema)
    data = [pa.array(values, field.type) for values, field in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(data, schema=arrow), schema)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if it is not there, in the warehouse or at a location of its own."""
    place = f" LOCATION '{location}'" if location is not None else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def ensure(spark: SparkSession, target: str, schema: T.StructType) -> None:
    """Create the (unpartitioned) table empty if it is not there."""
    if not exists(spark, target):
        overwrite(inline_rows(spark, [], schema), target)


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str]):
    writer = df.write.format("parquet").mode(mode).option("compression", COMPRESSION)
    return writer.partitionBy(*partition_by) if partition_by else writer


def _save(writer, target: str) -> None:
    if is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(target)


def rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a table partition together before a write.

    Without this every task would write a small file into every partition. A rebalance (rather
    than a repartition) lets Spark split a partition that holds much of the data over several
    tasks and join small ones, so one busy day does not end up in one task.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def overwrite(
    df: DataFrame, target: str, partition_by: Sequence[str] = (), spread: bool = True
) -> DataFrame:
    """Replace the whole table, schema included; returns it as written."""
    rows = rebalanced(df, partition_by) if spread else df
    _save(_writer(rows, "overwrite", partition_by), target)
    return read(df.sparkSession, target, df.schema)


def in_partitions(df: DataFrame, partition_by: Sequence[str], values: Sequence[Sequence]) -> DataFrame:
    """Only the given table partitions, as literals so that the scan lists nothing else."""
    wanted = [
        " AND ".join(f"`{c}` <=> {X.sql_literal(v)}" for c, v in zip(partition_by, row))
        for row in values
    ]
    return df.where(" OR ".join(f"({one})" for one in wanted) or "false")


def append(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    _save(_writer(df, "append", partition_by), target)


def overwrite_partitions(
    df: DataFrame, target: str, partition_by: Sequence[str], spread: bool = True
) -> None:
    """Replace only the table partitions that ``df`` has rows for; creates a missing table."""
    spark = df.sparkSession
    rows = rebalanced(df, partition_by) if spread else df
    if is_path(target):
        writer = _writer(rows, "overwrite", partition_by)
        writer.option("partitionOverwriteMode", "dynamic").save(target)
    elif not exists(spark, target):
        _save(_writer(rows, "error", partition_by), target)
    else:
        # insertInto takes the mode from the session only; as a write option it has no effect.
        mode = spark.conf.get(_OVERWRITE_MODE)
        spark.conf.set(_OVERWRITE_MODE, "dynamic")
        try:
            rows = rows.select(*spark.table(target).columns)
            rows.write.mode("overwrite").insertInto(target)
        finally:
            spark.conf.set(_OVERWRITE_MODE, mode)


from strata.sources import snapshots  # noqa: E402  (it builds on this module)
