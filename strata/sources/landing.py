"""Landed files: what is there, what is still to load, and loading it.

A landed file belongs to one (year, month), which its path tells. A load writes the rows of a bounded
chunk of files to bronze and makes them part of it in one commit (``snapshots``); then the chunk is
recorded in the ledger. A run that dies before the commit has loaded nothing; one that dies before
the ledger is written is found by the files of the newest commit, and recorded by the next run.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path
from strata.sources import snapshots, tables

# Year and month in a file path such as .../2024-01.parquet or .../year=2024/month=01/part-0.parquet
MONTH_IN_PATH = r"(?:^|[^0-9])([0-9]{4})(?:-|/month=)([0-9]{2})(?:\.parquet$|/[^/]*\.parquet$)"
BRONZE_PARTITIONS = ("year", "month")
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("file_size_bytes", T.LongType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("ingestion_batch_id", T.StringType()),
        T.StructField("row_count", T.LongType()),
    ]
)
# What a load adds to the landed columns.
LINEAGE_SCHEMA = T.StructType(
    [
        T.StructField("_source_file", T.StringType()),
        T.StructField("_ingestion_timestamp", T.TimestampType()),
        T.StructField("_ingestion_batch_id", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)


MONTH_SCHEMA = "year int, month int"
FILE_SCHEMA = "source_file string, file_size_bytes bigint, year int, month int"
# Files per write of a load. Their list is broadcast to the rows and read by the driver.
FILES_PER_WRITE = 10_000


def file_of_row() -> Column:
    """The file a row was read from, spelt as the file listing spells it."""
    path = F.col("_metadata.file_path")
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(path, F.lit("%")), decoded).otherwise(path)


def with_month(files: DataFrame, path: str, pattern: str = MONTH_IN_PATH) -> DataFrame:
    """Add year and month to one row per file; only files whose path tells a month."""
    return files.withColumns(
        {
            "year": F.regexp_extract(path, pattern, 1).try_cast("int"),
            "month": F.regexp_extract(path, pattern, 2).try_cast("int"),
        }
    ).where(F.col("year").isNotNull() & F.col("month").between(1, 12))


def listing(spark: SparkSession, landing: str) -> DataFrame:
    """One row per landed file, whatever its name. Names and sizes only; no file is opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(landing)
        .select(F.col("path").alias("source_file"), F.col("length").alias("file_size_bytes"))
    )


def manifest(spark: SparkSession, landing: str, pattern: str = MONTH_IN_PATH) -> DataFrame:
    """One row per landed Parquet file that names a month: path, size, year, month."""
    return with_month(listing(spark, landing), "source_file", pattern)


def unmatched(files: DataFrame, pattern: str = MONTH_IN_PATH) -> DataFrame:
    """The landed files (``listing``) that the manifest leaves out, because their path tells no month."""
    return files.join(with_month(files, "source_file", pattern), "source_file", "left_anti")


def missing_months(files: DataFrame, expected: Sequence[tuple[int, int]]) -> DataFrame:
    """The expected (year, month) pairs without a landed file."""
    wanted = tables.inline_rows(files.sparkSession, list(expected), T.StructType.fromDDL(MONTH_SCHEMA))
    return wanted.join(files, ["year", "month"], "left_anti")


def reconcile(
    landed: DataFrame,
    ledger: DataFrame,
    bronze: DataFrame,
    expected: Sequence[tuple[int, int]] = (),
    pattern: str = MONTH_IN_PATH,
) -> DataFrame:
    """One row per file that is landed, recorded or in bronze, and per expected month without a file.

    ``landed`` is a ``listing``, ``bronze`` any frame with ``_source_file``. ``status`` is the first that holds of:
    ``no month`` (the path tells none), ``not recorded`` (rows in bronze, none in the ledger), ``rows differ``
    (bronze and ledger), ``lost`` (recorded, not landed any more), ``size changed`` (since it was recorded),
    ``pending``, ``loaded``; ``month missing`` for a month. The sides are grouped by file in one shuffle, not
    joined one after the other; bronze comes as one row per file and task.
    """
    none = {name: F.lit(None).cast("bigint") for name in ("landed_bytes", "ledger_bytes", "ledger_rows", "bronze_rows")}

    def side(rows: DataFrame, file: str, **found) -> DataFrame:
        columns = {**none, **found}
        return rows.select(F.col(file).alias("source_file"), *(c.alias(name) for name, c in columns.items()))

    # The last record of a file counts, as a file may be recorded again after it changed.
    book = ledger.groupBy("source_file").agg(
        F.max_by("file_size_bytes", "ingested_at").alias("size"), F.max_by("row_count", "ingested_at").alias("n")
    )
    held = bronze.groupBy("_source_file").agg(F.count("*").alias("n"))
    sides = (
        side(landed, "source_file", landed_bytes=F.col("file_size_bytes"))
        .unionAll(side(book, "source_file", ledger_bytes=F.coalesce("size", F.lit(-1)), ledger_rows=F.col("n")))
        .unionAll(side(held, "_source_file", bronze_rows=F.col("n")))
    )
    files = sides.groupBy("source_file").agg(*(F.max(name).alias(name) for name in none))
    of_path = lambda part, low, high: F.when(
        F.regexp_extract("source_file", pattern, part).try_cast("int").between(low, high),
        F.regexp_extract("source_file", pattern, part).try_cast("int"),
    )
    files = files.withColumns({"year": of_path(1, 0, 9999), "month": of_path(2, 1, 12)})
    recorded = F.col("ledger_rows").isNotNull()
    status = (
        F.when(F.col("year").isNull() | F.col("month").isNull(), "no month")
        .when(~recorded & F.col("bronze_rows").isNotNull(), "not recorded")
        .when(recorded & (F.coalesce("bronze_rows", F.lit(0)) != F.col("ledger_rows")), "rows differ")
        .when(recorded & F.col("landed_bytes").isNull(), "lost")
        .when(recorded & (F.col("landed_bytes") != F.col("ledger_bytes")), "size changed")
        .when(recorded, "loaded")
        .otherwise("pending")
    )
    files = files.withColumn("status", status)
    months = missing_months(files.where(F.col("landed_bytes").isNotNull()), expected)
    months = months.select(
        F.lit(None).cast("string").alias("source_file"), *(c.alias(name) for name, c in none.items()),
        "year", "month", F.lit("month missing").alias("status"),
    )
    return files.unionByName(months)


def pending(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """The files whose path is not in the ledger."""
    return files.join(ledger.select("source_file"), "source_file", "left_anti")


def file_status(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """All files with ``status``: ``pending``, ``loaded``, or ``size changed`` since they were recorded."""
    known = ledger.groupBy("source_file").agg(
        F.max_by("file_size_bytes", "ingested_at").alias("_known_size"), F.lit(True).alias("_known")
    )
    status = (
        F.when(F.col("_known").isNull(), "pending")
        .when(F.col("_known_size") != F.col("file_size_bytes"), "size changed")
        .otherwise("loaded")
    )
    return files.join(known, "source_file", "left").withColumn("status", status).drop("_known_size", "_known")


def with_lineage(rows: DataFrame, files: DataFrame, batch_id: str) -> DataFrame:
    """Add year and month of ``_source_file``, the load time and the batch id.

    ``files`` is a chunk of at most ``FILES_PER_WRITE`` files. Looking a path up costs a row far less than
    matching a pattern would. A row of a file that is not listed is an error, never dropped.
    """
    known = files.select(F.col("source_file").alias("_source_file"), "year", "month")
    rows = rows.join(F.broadcast(known), "_source_file", "left")
    unlisted = F.raise_error(F.concat(F.lit("not a listed file: "), "_source_file"))
    return rows.withColumns(
        {
            "year": F.coalesce("year", unlisted.cast("int")),
            "_ingestion_timestamp": F.current_timestamp(),
            "_ingestion_batch_id": F.lit(batch_id),
        }
    )


def chunks(files: DataFrame) -> Iterator[DataFrame]:
    """The files in stored chunks of at most ``FILES_PER_WRITE``; the driver holds one chunk's list at a time."""
    spark, schema = files.sparkSession, T.StructType.fromDDL(FILE_SCHEMA)
    staged = tables.overwrite(files.select(*schema.names), scratch_path(spark, "files-pending"))
    rows = staged.orderBy("source_file").toLocalIterator()
    while part := list(itertools.islice(rows, FILES_PER_WRITE)):
        listed = tables.inline_rows(spark, part, schema)
        yield tables.overwrite(listed, scratch_path(spark, "files-chunk"))


def chunk_rows(files: DataFrame, batch_id: str) -> DataFrame:
    """The rows of a stored chunk of files, with their lineage.

    All files are read in one scan. Their list is in the scan and in the stored chunk, not in the plan.
    """
    paths = [row.source_file for row in files.select("source_file").collect()]
    rows = files.sparkSession.read.option("mergeSchema", "true").parquet(*paths)
    return with_lineage(rows.withColumn("_source_file", file_of_row()), files, batch_id)


def load_chunk(files: DataFrame, bronze: str, ledger: str, batch_id: str) -> None:
    """Load a stored chunk of files and record it; a task writes the rows of the split it read, unshuffled."""
    snapshots.add(chunk_rows(files, batch_id), bronze, BRONZE_PARTITIONS, spread=False)
    record(files, ledger, batch_id)


def record(files: DataFrame, ledger: str, batch_id: str) -> None:
    """Add a stored chunk of loaded files to the ledger."""
    spark = files.sparkSession
    paths = [row.source_file for row in files.select("source_file").collect()]
    tables.append(ledger_rows(files, source_counts(spark, paths), batch_id), ledger)


def unrecorded(spark: SparkSession, bronze: str, ledger: DataFrame) -> DataFrame:
    """(source_file, batch id) of the newest commit's files that the ledger lacks: a run died between the two.

    Only the files of the newest commit are looked at, so the cost is that of one chunk.
    """
    added = [row.path for row in snapshots.added_by_latest(spark, bronze).select("path").collect()]
    rows = snapshots.read_files(spark, bronze, added, LINEAGE_SCHEMA)
    loaded = rows.groupBy(F.col("_source_file").alias("source_file")).agg(
        F.max("_ingestion_batch_id").alias("ingestion_batch_id")
    )
    return loaded.join(ledger.select("source_file"), "source_file", "left_anti")


def lineage(spark: SparkSession, bronze: str) -> DataFrame:
    """The lineage columns of bronze; counting them reads no column of the data."""
    return tables.read_or_empty(spark, bronze, LINEAGE_SCHEMA)


def source_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows per landed file, from the files themselves and not from what was written of them.

    No column of the data is read, so Spark takes the counts from the footers.
    """
    rows = spark.read.parquet(*paths).select(file_of_row().alias("source_file"))
    return rows.groupBy("source_file").agg(F.count("*").alias("row_count"))


def ledger_rows(files: DataFrame, counts: DataFrame, batch_id: str) -> DataFrame:
    """Ledger rows of a batch: a file without rows counts as zero."""
    return files.join(counts, "source_file", "left").select(
        "source_file",
        "file_size_bytes",
        F.current_timestamp().alias("ingested_at"),
        F.lit(batch_id).alias("ingestion_batch_id"),
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
    )


def ledger_from_bronze(bronze: DataFrame, files: DataFrame) -> DataFrame:
    """Ledger rows rebuilt from the lineage columns of bronze; the size is NULL for a lost file."""
    per_file = bronze.groupBy(F.col("_source_file").alias("source_file")).agg(
        F.min("_ingestion_timestamp").alias("ingested_at"),
        F.min("_ingestion_batch_id").alias("ingestion_batch_id"),
        F.count("*").alias("row_count"),
    )
    sizes = files.select("source_file", "file_size_bytes")
    return per_file.join(sizes, "source_file", "left").select(*LEDGER_SCHEMA.names)
