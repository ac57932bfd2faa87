"""Run registered queries next to their oracle SQL: python tests/oracle_compare.py [sf] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from strata.session import build_session  # noqa: E402

TABLES = (
    *("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"),
    *("documents", "embeddings", "pages", "benchmark", "labels", "conversations"),
)


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(row[i] for i in order) for row in rows]
    return [names[i] for i in order], sorted(cells, key=repr)


def differences(spark, con, name, sf_dir) -> str | None:
    """None if columns, rows and values are equal, else what differs."""
    frame = entry.queries()[name](spark, sf_dir)
    got_names, got = _sorted(frame.columns, [tuple(row) for row in frame.collect()])
    result = con.execute(entry.oracle_sql()[name])
    want_names, want = _sorted([c[0] for c in result.description], result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows, oracle {len(want)}"
    for left, right in zip(got, want):
        if repr(left) != repr(right):
            return f"{got_names}\n   got    {left}\n   oracle {right}"
    return None


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = oracle(sf_dir), 0
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            if name in entry.oracle_sql():
                problem = differences(spark, con, name, sf_dir)
            else:
                problem = None if entry.queries()[name](spark, sf_dir).count() else "no rows"
        except Exception as error:  # report every query, not only the first broken one
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
