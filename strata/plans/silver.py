"""Silver: normalise, validate, quarantine, deduplicate, merge, and record the run."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import trips
from strata.functions import expressions as X
from strata.operators import dedup, rules, upsert
from strata.operators.normalize import normalize, with_month
from strata.session import scratch_path
from strata.sources import tables
from strata.specs import Rule

PARTITIONS = ("year", "month")
METRICS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_clean", T.LongType()),
        T.StructField("rows_quarantined", T.LongType()),
        T.StructField("rows_deduped", T.LongType()),
        T.StructField("rules_failed", T.MapType(T.StringType(), T.LongType())),
        T.StructField("bronze_table", T.StringType()),
    ]
)


@dataclass(frozen=True)
class SilverTables:
    clean: str
    quarantine: str
    metrics: str


def normalized_trips(
    raw: DataFrame,
    load_time: Column | None = None,
    columns=trips.TRIP_COLUMNS,
    track_casts: bool = False,
) -> DataFrame:
    rows = normalize(
        raw, columns, trips.START, trips.END, trips.DURATION, trips.LOADED_AT, load_time, track_casts
    )
    return with_month(rows, trips.START)


def row_hash(columns: Iterable[str], skip: Sequence[str] = trips.HASH_SKIP) -> Column:
    return X.content_hash(c for c in columns if c not in skip)


def with_row_hash(df: DataFrame, skip: Sequence[str] = trips.HASH_SKIP) -> DataFrame:
    """Add the hash of the business columns: all but load time, source file and partitions."""
    return df.withColumn(trips.ROW_HASH, row_hash(df.columns, skip))


def clean_batch(normalized: DataFrame, checks: Sequence[Rule]) -> DataFrame:
    """The valid rows, one per key, with their hash."""
    valid = rules.without_flags(rules.clean(normalized, checks), trips.TRIP_COLUMNS)
    return with_row_hash(dedup.latest_per_key(valid, trips.TRIP_KEY, trips.LOADED_AT))


@dataclass(frozen=True)
class RunCounts:
    rows_in: int
    rows_clean: int
    rows_quarantined: int
    rows_deduped: int


def metrics_row(
    run_id: str,
    started_at: dt.datetime,
    finished_at: dt.datetime,
    bronze_table: str,
    counts: RunCounts,
    rejected: DataFrame,
) -> DataFrame:
    """One run as a row; the failures per rule are counted over the rejected rows alone."""
    failures = rules.rule_map(rules.rule_counts(rejected)).first()["rules_failed"]
    row = (run_id, started_at, finished_at, *astuple(counts), failures, bronze_table)
    return rejected.sparkSession.createDataFrame([row], METRICS_SCHEMA)


def run(
    bronze: DataFrame,
    target: SilverTables,
    bronze_table: str,
    checks: Sequence[Rule] | None = None,
    load_time: Column | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Bronze to silver; returns the metrics row of this run.

    ``target`` holds paths or catalog names. The plan of bronze is run once, into a staged table of normalised
    and judged rows; the rejected rows, the clean batch and the counts come from it. A value that its type cannot hold fails
    the row by a rule of its own (``rules.cast_rules``), before ``checks``. The other counts come from the files just written (their footers), not
    from accumulators, so a lost executor or a repeated task cannot count a row twice.

    ``rows_clean`` is the whole clean table after the merge. Quarantine holds this run only.
    """
    spark = bronze.sparkSession
    run_id, started_at = str(uuid.uuid4()), dt.datetime.now(dt.timezone.utc)
    checks = (*rules.cast_rules(trips.TRIP_COLUMNS), *(trips.trip_rules() if checks is None else checks))
    load_time = F.lit(started_at) if load_time is None else load_time
    rows = normalized_trips(bronze, load_time, track_casts=True)
    rows = tables.overwrite(rows, scratch_path(spark, "normalised"))
    # The codes are built behind the shuffle of the write, so their text is not moved.
    bad = tables.rebalanced(rows.where(~rules.valid(checks)), PARTITIONS)
    bad = rules.without_flags(rules.quarantine(bad, checks), trips.TRIP_COLUMNS)
    rejected = tables.overwrite(bad, target.quarantine, PARTITIONS, spread=False)
    unique = clean_batch(rows, checks)
    merged = upsert.upsert(
        unique, target.clean, trips.TRIP_KEY, PARTITIONS, trips.ROW_HASH, trips.LOADED_AT, null_safe,
        row_hash=row_hash(c for c in unique.columns if c != trips.ROW_HASH),
    )
    batch = sum(row.row_count for row in merged.collect() if row.action != "kept")
    # Measured in one pass, not a remainder: a row lost on the way would else pass as a duplicate.
    rows_in, valid = rows.agg(F.count("*"), F.count_if(rules.valid(checks))).first()
    quarantined = rejected.count()
    if rows_in != valid + quarantined:
        raise RuntimeError(f"{rows_in} rows read, but {valid} valid and {quarantined} rejected")
    counts = RunCounts(
        rows_in=rows_in,
        rows_clean=tables.read(spark, target.clean, unique.schema).count(),
        rows_quarantined=quarantined,
        rows_deduped=valid - batch,
    )
    finished_at = dt.datetime.now(dt.timezone.utc)
    row = metrics_row(run_id, started_at, finished_at, bronze_table, counts, rejected)
    tables.append(row, target.metrics)
    return row
