"""Streams: the bronze load as a stream of files, and an upsert from any stream.

A micro-batch is written in one commit that keeps the stream's name and the number of the batch. A
micro-batch that is run again after a crash finds its number there and is skipped, so every row is
loaded once, whether the run died before or after its commit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.operators import dedup, upsert
from strata.session import scratch_path
from strata.sources import landing, snapshots, tables


FILES_PER_BATCH = 1000


def is_done(spark: SparkSession, target: str, stream: str, number: int) -> bool:
    """Whether the table has this batch of the stream, or a later one."""
    path = snapshots.place(spark, target)
    return snapshots.streams(spark, path).get(stream, -1) >= number


def upsert_available(
    source: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    hash_column: str,
    version_column: str,
    row_hash: Column | None = None,
) -> StreamingQuery:
    """Upsert all a stream has to give into a table (a path or a catalog name), batch by batch, and stop.

    A batch holds the latest row per key, so a key that changed often in it is merged once. The
    name of the stream in the commits is its checkpoint folder. ``row_hash`` as in ``upsert.upsert``.
    """
    spark = source.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        if not is_done(spark, target, checkpoint, number):
            latest = dedup.latest_per_key(upsert.packed(batch, hash_column, row_hash), keys, version_column)
            latest = upsert.unpacked(latest, hash_column, row_hash)
            upsert.upsert(
                latest, target, keys, partition_by, hash_column, version_column,
                stream=(checkpoint, number), row_hash=row_hash,
            )

    return (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def file_stream(spark: SparkSession, landing_path: str, schema: T.StructType | str) -> DataFrame:
    """The landed rows as a stream, each with the path and the size of its file."""
    rows = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", FILES_PER_BATCH)
        .parquet(landing_path)
    )
    return rows.withColumns(
        {"_source_file": landing.file_of_row(), "_file_size": F.col("_metadata.file_size")}
    )


def load_available(
    spark: SparkSession,
    landing_path: str,
    schema: T.StructType | str,
    bronze: str,
    ledger: str,
    checkpoint: str,
    pattern: str = landing.MONTH_IN_PATH,
) -> StreamingQuery:
    """Load all files landed since the last run, record them in the ledger, and stop."""
    tables.ensure(spark, ledger, landing.LEDGER_SCHEMA)

    def load(batch: DataFrame, number: int) -> None:
        batch_id = f"stream-{number}"
        # The batch names its files itself (at most FILES_PER_BATCH); none is listed again.
        sizes = batch.groupBy("_source_file").agg(F.max("_file_size").alias("file_size_bytes"))
        files = landing.with_month(sizes, "_source_file", pattern)
        files = files.withColumnRenamed("_source_file", "source_file")
        files = tables.overwrite(files, scratch_path(spark, "stream-files"))
        if not is_done(spark, bronze, checkpoint, number):
            known = files.select(F.col("source_file").alias("_source_file"))
            listed = batch.drop("_file_size").join(F.broadcast(known), "_source_file", "left_semi")
            rows = landing.with_lineage(listed, files, batch_id)
            snapshots.add(rows, bronze, landing.BRONZE_PARTITIONS, False, (checkpoint, number))
        for chunk in landing.chunks(landing.pending(files, tables.read(spark, ledger, landing.LEDGER_SCHEMA))):
            landing.record(chunk, ledger, batch_id)

    return (
        file_stream(spark, landing_path, schema)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
