"""Parquet folders with a commit list: which files are the table, as of which commit.

A commit is a folder ``_commits/<number>-<id>`` that lists every valid file. It counts once Spark has
put its ``_SUCCESS`` mark there, which is one small file, so a reader sees all of a change or nothing
of it. Data files lie in their table partitions as in any Parquet folder; files that no commit lists
(left by a run that died, or superseded) are not read and go with ``vacuum``. A plain Parquet folder is a
table whose files are all valid; its first commit makes it a table with a list.

A catalog name is a view over such a folder that keeps the files of one commit. Replacing the view
is one change in the catalog, so SQL readers never see a commit by halves either.

One writer at a time; a commit on top of another one than it began with is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path
from strata.sources import tables

COMMITS = "_commits"
LOCATION = "strata.location"
FILE_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("bytes", T.LongType()),
    ]
)


def _commit_folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the finished commits, oldest first."""
    files, folder = tables.hadoop_path(spark, f"{path}/{COMMITS}")
    if not files.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(folder)]
    done = [name for name in names if tables.file_exists(spark, f"{path}/{COMMITS}/{name}/_SUCCESS")]
    return sorted(done)


def latest(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest commit, or None for a plain (or no) table."""
    names = _commit_folders(spark, path)
    return f"{path}/{COMMITS}/{names[-1]}" if names else None


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """The files below a folder: ``file`` (as ``_metadata.file_path`` spells it), ``path``, ``bytes``."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.select(F.col("_metadata.file_path").alias("file"), "path", F.col("length").alias("bytes"))


def files(spark: SparkSession, path: str) -> DataFrame:
    """The valid files of the table."""
    commit = latest(spark, path)
    if commit is None:
        return listed(spark, path)
    return spark.read.parquet(commit).select("file", "path", "bytes")


def read_files(
    spark: SparkSession,
    path: str,
    paths: Sequence[str],
    schema: T.StructType | str | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Some files of the table, with its partition columns; for none of them a schema is needed."""
    reader = spark.read.option("basePath", path).option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    if not paths:
        return reader.option("pathGlobFilter", "no file").parquet(path)
    return reader.parquet(*paths)


def no_files(spark: SparkSession) -> DataFrame:
    return tables.inline_rows(spark, [], FILE_SCHEMA)


def read(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    commit: str | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """The table as of a commit (the newest if not given).

    The list of files comes to the driver, as the file index of any Spark scan does.
    """
    rows = spark.read.parquet(commit or latest(spark, path)).select("path").collect()
    return read_files(spark, path, sorted(row.path for row in rows), schema, merge_schema)


def streams(spark: SparkSession, path: str) -> dict[str, int]:
    """The last batch number of each stream that has written to the table."""
    commit = latest(spark, path)
    first = spark.read.parquet(commit).select("streams").first() if commit is not None else None
    return dict(first.streams or {}) if first is not None else {}


def added_by_latest(spark: SparkSession, path: str) -> DataFrame:
    """The files that the newest commit lists and the one before it does not."""
    names = _commit_folders(spark, path)[-2:]
    found = [spark.read.parquet(f"{path}/{COMMITS}/{name}").select("file", "path") for name in names]
    if not found:
        return no_files(spark).select("file", "path")
    return found[1].join(found[0], "file", "left_anti") if len(found) == 2 else found[0]


def append_files(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), spread: bool = True
) -> DataFrame:
    """Write rows as new files that no commit lists yet; returns the list of these files.

    A task that is repeated leaves no second file: Spark moves files in place when the job commits.
    """
    spark = df.sparkSession
    before = None
    if tables.path_exists(spark, path):
        # Written down first: listed again later it would hold the new files too.
        before = tables.overwrite(listed(spark, path).select("file"), scratch_path(spark, "files"))
    tables.append(tables.rebalanced(df, partition_by) if spread else df, path, partition_by)
    after = listed(spark, path)
    return after.join(before, "file", "left_anti") if before is not None else after


def commit(
    spark: SparkSession,
    path: str,
    valid: DataFrame,
    based_on: str | None,
    stream: tuple[str, int] | None = None,
) -> str:
    """Make ``valid`` (file, path, bytes) the table; ``stream`` names a stream and the batch it wrote."""
    if latest(spark, path) != based_on:
        raise RuntimeError(f"{path} has a newer commit than {based_on}; another run wrote to it")
    number = int(based_on.rsplit("/", 1)[1].split("-")[0]) + 1 if based_on else 1
    written = streams(spark, path) | (dict([stream]) if stream else {})
    known = [item for pair in written.items() for item in map(F.lit, pair)]
    state = F.create_map(*known) if known else F.lit(None)
    name = f"{path}/{COMMITS}/{number:010d}-{uuid.uuid4().hex}"
    rows = valid.select("file", "path", "bytes", state.cast("map<string,bigint>").alias("streams"))
    # A list of names: a few files, whatever the number of tasks that made it.
    rows.coalesce(4).write.parquet(name)
    return name


def location(spark: SparkSession, name: str) -> str | None:
    """The folder behind a catalog name made by ``publish``; None if there is no such name."""
    if not spark.catalog.tableExists(name):
        return None
    properties = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return properties.get(LOCATION)


def new_location(spark: SparkSession, name: str) -> str:
    """Where a new catalog name keeps its files: beside the managed tables of its database."""
    database, _, table = name.rpartition(".")
    home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{home}/{table}.files"


def publish(spark: SparkSession, name: str, path: str, columns: Sequence[str]) -> None:
    """Point a catalog name at the newest commit of a folder."""
    if spark.catalog.tableExists(name) and location(spark, name) != path:
        raise ValueError(f"{name} is there already and is not a view over {path}")
    shown = ", ".join(f"`{c}`" for c in columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{LOCATION}' = '{path}') AS "
        f"SELECT {shown} FROM parquet.`{path}` "
        f"WHERE _metadata.file_path IN (SELECT file FROM parquet.`{latest(spark, path)}`)"
    )


def place(spark: SparkSession, target: str) -> str:
    """The folder of a target: the path itself, or the one behind (or for) a catalog name."""
    if tables.is_path(target):
        return target
    path = location(spark, target)
    if path is None and spark.catalog.tableExists(target):
        raise ValueError(f"{target} is a table without a commit list; use a new name or its path")
    return path or new_location(spark, target)


def replace_partitions(
    df: DataFrame, target: str, partition_by: Sequence[str], values: Sequence[Sequence]
) -> DataFrame:
    """Make ``df`` all there is of the given table partitions, in one commit; returns the table.

    Files of other partitions stay as they are. A partition without rows in ``df`` is empty afterwards.
    """
    spark, path = df.sparkSession, place(df.sparkSession, target)
    based_on = latest(spark, path)
    if based_on is None and not tables.path_exists(spark, path):
        based_on = commit(spark, path, no_files(spark), None)
    old = tables.in_partitions(tables.read(spark, path, df.schema), partition_by, values)
    stale = old.select(F.col("_metadata.file_path").alias("file")).distinct()
    # Pinned before new files are added, which a plain folder would take for old ones.
    kept = files(spark, path).join(stale, "file", "left_anti")
    kept = tables.overwrite(kept, scratch_path(spark, "files-kept"))
    added = append_files(df, path, partition_by)
    commit(spark, path, kept.unionByName(added), based_on)
    if path != target:
        publish(spark, target, path, df.columns)
    return tables.read(spark, path, df.schema)


def add(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    spread: bool = True,
    stream: tuple[str, int] | None = None,
) -> None:
    """Add rows to a path table in one commit."""
    spark = df.sparkSession
    based_on = latest(spark, path)
    if based_on is None and not tables.path_exists(spark, path):
        based_on = commit(spark, path, no_files(spark), None)
    before = tables.overwrite(files(spark, path), scratch_path(spark, "files-valid"))
    added = append_files(df, path, partition_by, spread)
    commit(spark, path, before.unionByName(added), based_on, stream)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete what the newest ``keep`` commits do not need; returns the number of data files deleted.

    A reader of an older commit loses its files, so keep as many as the longest query may span.
    """
    names = _commit_folders(spark, path)
    if not names:
        return 0
    old, held = names[:-keep], [f"{path}/{COMMITS}/{name}" for name in names[-keep:]]
    needed = spark.read.parquet(*held).select("file")
    unused = listed(spark, path).join(needed, "file", "left_anti").select("path")
    deleted = 0
    for row in unused.toLocalIterator():
        tables.drop_path(spark, row.path)
        deleted += 1
    for name in old:
        tables.drop_path(spark, f"{path}/{COMMITS}/{name}")
    return deleted


def is_table(spark: SparkSession, target: str) -> bool:
    """Whether the target, a path or a catalog name, has a commit list."""
    try:
        path = target if tables.is_path(target) else location(spark, target)
    except AnalysisException:
        return False
    return path is not None and latest(spark, path) is not None
