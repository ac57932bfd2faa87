"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.operators.joins import fits
from strata.session import scratch_path
from strata.sources import tables

# Up to here all rows are numbered in one task.
ONE_TASK_ROWS = 100_000
# monotonically_increasing_id() holds the partition number above its low 33 bits.
_ID_BITS = 33


def dense_key(
    df: DataFrame,
    natural_key: str,
    name: str,
    known_rows: int | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Put a key 1, 2, 3, ... in the order of ``natural_key`` (which must be unique) in front."""
    small = known_rows <= one_task_rows if known_rows is not None else fits(df, one_task_rows)
    if small:
        position = F.row_number().over(Window.orderBy(natural_key))
        return df.select(position.cast("bigint").alias(name), *df.columns)
    return _dense_key_by_range(df, natural_key, name)


def _dense_key_by_range(df: DataFrame, natural_key: str, name: str) -> DataFrame:
    """Number every key range by itself, then shift it by the rows of the ranges before it.

    One range shuffle and a local sort. The ranges are written to a staged table, so a lost
    executor cannot change them between the count and the numbering.
    """
    spark = df.sparkSession
    ordered = df.repartitionByRange(natural_key).sortWithinPartitions(natural_key)
    placed = ordered.withColumn("_id", F.monotonically_increasing_id()).withColumns(
        {
            "_range": F.shiftright("_id", _ID_BITS),
            "_place": F.col("_id") - F.shiftleft(F.shiftright("_id", _ID_BITS), _ID_BITS),
        }
    )
    staged = tables.overwrite(placed.drop("_id"), scratch_path(spark, "key-ranges"))
    # One row per shuffle partition, so the running total fits one task and the broadcast is small.
    ahead = F.sum("_rows").over(Window.orderBy("_range")) - F.col("_rows")
    offsets = (
        staged.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select("_range", ahead.alias("_ahead"))
    )
    key = (F.col("_ahead") + F.col("_place") + 1).cast("bigint")
    return staged.join(F.broadcast(offsets), "_range").select(key.alias(name), *df.columns)
