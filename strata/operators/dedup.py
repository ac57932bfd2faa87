"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

_UNORDERED = (T.MapType, T.VariantType)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """The row with the greatest ``order_by`` per key; rows with a NULL key form a group too.

    Ties are settled by the remaining columns, so the result does not depend on the layout.
    Spark keeps the first row per key in every task before it shuffles (WindowGroupLimit), so a
    key that holds much of the table costs one row per task, not one huge group.
    """
    if order_by not in df.columns:
        raise ValueError(f"latest_per_key needs the column {order_by}, found {df.columns}")
    settled = {*keys, order_by}
    ties = [
        F.col(f"`{field.name}`").asc_nulls_last()
        for field in df.schema
        if field.name not in settled and not isinstance(field.dataType, _UNORDERED)
    ]
    # The hash of the key leads the sort, so nearly every comparison ends at its 8-byte prefix,
    # even where the first key column has few values. The key columns still decide.
    rank = F.row_number().over(
        Window.partitionBy("_key_hash", *keys).orderBy(F.col(order_by).desc_nulls_last(), *ties)
    )
    return (
        df.withColumn("_key_hash", F.xxhash64(*keys))
        .withColumn("_rank", rank)
        .where("_rank = 1")
        .drop("_rank", "_key_hash")
    )
