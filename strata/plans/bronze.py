"""Bronze: load landed files once, and keep a ledger of them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import checks
from strata.session import scratch_path
from strata.sources import landing, snapshots, tables


def _read(spark: SparkSession, ledger: str) -> DataFrame:
    return tables.read(spark, ledger, landing.LEDGER_SCHEMA)


def backfill_ledger(spark: SparkSession, bronze: str, ledger: str, files: DataFrame) -> int:
    """Rebuild an empty ledger from the lineage columns of a loaded bronze table; returns its rows.

    The landed files are counted too: a file that is gone, or of which bronze holds another number of
    rows, is an error, as the ledger would take a part for the whole.
    """
    if not tables.exists(spark, bronze) or not _read(spark, ledger).isEmpty():
        return 0
    rebuilt = landing.ledger_from_bronze(landing.lineage(spark, bronze), files)
    rebuilt = tables.overwrite(rebuilt, scratch_path(spark, "ledger-rebuilt"))
    lost = rebuilt.where(F.col("file_size_bytes").isNull()).limit(5).collect()
    if lost:
        names = ", ".join(row.source_file for row in lost)
        raise FileNotFoundError(f"bronze holds rows of files that are not landed any more: {names}")
    for chunk in landing.chunks(files.join(rebuilt, "source_file", "left_semi")):
        paths = [row.source_file for row in chunk.select("source_file").collect()]
        counts = landing.source_counts(spark, paths).withColumnRenamed("row_count", "landed_rows")
        pairs = rebuilt.join(chunk.select("source_file"), "source_file").join(counts, "source_file", "left")
        differ = pairs.where("row_count <> coalesce(landed_rows, 0)").limit(5).collect()
        if differ:
            names = ", ".join(f"{r.source_file} ({r.row_count} of {r.landed_rows} rows)" for r in differ)
            raise ValueError(f"bronze does not hold whole files: {names}")
    tables.append(rebuilt, ledger)
    return _read(spark, ledger).count()


def recover_ledger(spark: SparkSession, bronze: str, ledger: str, files: DataFrame) -> None:
    """Record the chunk of a run that died between its commit to bronze and its record in the ledger."""
    if snapshots.latest(spark, bronze) is None:
        return
    found = landing.unrecorded(spark, bronze, _read(spark, ledger))
    found = tables.overwrite(found, scratch_path(spark, "files-unrecorded"))
    batches = [row[0] for row in found.select("ingestion_batch_id").distinct().collect()]
    for batch_id in batches:  # one, as a commit is a chunk of one batch
        mine = found.where(F.col("ingestion_batch_id") == batch_id).select("source_file")
        for chunk in landing.chunks(files.join(mine, "source_file", "left_semi")):
            landing.record(chunk, ledger, batch_id)


def reconcile(spark: SparkSession, bronze: str, ledger: str) -> DataFrame:
    """The rows in bronze are the rows in the ledger."""
    counts = checks.row_counts(
        {
            "bronze": landing.lineage(spark, bronze),
            "ledger": (_read(spark, ledger), "row_count"),
        }
    )
    return checks.report(counts, [checks.same_count("bronze = ledger", "ledger", "bronze")])


def ingest(
    spark: SparkSession,
    landing_path: str,
    bronze: str,
    ledger: str,
    batch_id: str | None = None,
    pattern: str = landing.MONTH_IN_PATH,
    expected_months: Sequence[tuple[int, int]] = (),
) -> DataFrame:
    """Load every landed file that is not in the ledger, record it, and reconcile.

    Returns one row: files found, files whose path tells no month, expected months without a file,
    files loaded, rows loaded, rows in bronze, rows in the ledger, and whether all is well: bronze
    holds what the ledger says, no file was left out, and no expected month is missing. The ledger
    counts the rows of the landed files, so rows lost while writing bronze show as a difference.
    A second run over the same files loads nothing.
    """
    batch_id = batch_id or str(uuid.uuid4())
    tables.ensure(spark, ledger, landing.LEDGER_SCHEMA)
    # The landing folder is listed once a run; all that follows reads this list.
    landed = tables.overwrite(landing.listing(spark, landing_path), scratch_path(spark, "landed"))
    files = landing.with_month(landed, "source_file", pattern)
    if not backfill_ledger(spark, bronze, ledger, files):
        recover_ledger(spark, bronze, ledger, files)
    for chunk in landing.chunks(landing.pending(files, _read(spark, ledger))):
        landing.load_chunk(chunk, bronze, ledger, batch_id)
    book = _read(spark, ledger)
    loaded = book.where(F.col("ingestion_batch_id") == batch_id)
    counts = checks.row_counts(
        {
            "files_landed": landed,
            "files_unmatched": landing.unmatched(landed, pattern),
            "months_missing": landing.missing_months(files, expected_months),
            "files_loaded": loaded,
            "rows_loaded": (loaded, "row_count"),
            "rows_bronze": landing.lineage(spark, bronze),
            "rows_ledger": (book, "row_count"),
        }
    )
    whole = (F.col("files_unmatched") == 0) & (F.col("months_missing") == 0)
    return counts.withColumn("passed", whole & (F.col("rows_bronze") == F.col("rows_ledger")))


def file_checks(files: DataFrame) -> DataFrame:
    """One check per bad status of ``landing.reconcile``: no file may have it.

    A file still to load, or one without a month, is a warning.
    """
    bad = ("not recorded", "rows differ", "lost", "size changed", "month missing")
    warned = ("pending", "no month")
    found = files.agg(*(F.count_if(F.col("status") == s).alias(s) for s in (*bad, *warned)))

    def row(status: str, severity: str):
        n = F.col(f"`{status}`")
        return checks.outcome(f"files: {status}", F.lit(0), n, n == 0, severity)

    return checks.report(found, [*(row(s, "error") for s in bad), *(row(s, "warn") for s in warned)])


def validate(
    spark: SparkSession,
    bronze: str,
    ledger: str,
    types: dict[str, str],
    required: tuple[str, ...],
    not_null: tuple[str, ...],
    landing_path: str | None = None,
    expected_months: Sequence[tuple[int, int]] = (),
    dates: tuple[str, int, tuple[int, int]] | None = None,
) -> DataFrame:
    """Bronze checks: not empty, equal to the ledger, columns and types, no NULL time.

    With ``landing_path`` also the files: landed, recorded and in bronze are the same, and no expected month
    is missing. ``dates`` (column, year, (first, last month)) warns of rows outside that range.
    """
    rows = tables.read(spark, bronze, merge_schema=True)
    counts = checks.row_counts({"bronze": rows, "ledger": (_read(spark, ledger), "row_count")})
    totals = checks.report(
        counts,
        [
            checks.not_empty("bronze is not empty", "bronze"),
            checks.same_count("bronze = ledger", "ledger", "bronze"),
        ],
    )
    columns = checks.schema_checks(rows, types, required).select(
        F.concat(F.lit("column "), "column_name").alias("check"),
        "expected",
        "actual",
        "passed",
        F.lit("error").alias("severity"),
    )
    report = totals.unionByName(columns).unionByName(checks.null_checks(rows, not_null))
    if landing_path is not None:
        landed, book = landing.listing(spark, landing_path), _read(spark, ledger)
        files = landing.reconcile(landed, book, landing.lineage(spark, bronze), expected_months)
        report = report.unionByName(file_checks(files))
    if dates is not None:
        column, year, months = dates
        rogue = checks.out_of_range_share(rows, f"{column} in range", column, year, months)
        report = report.unionByName(rogue.select(*report.columns))
    return report
