"""Every registered query against its oracle on the smallest given tables."""

import os

import pytest
from oracle_compare import differences, oracle

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    if name in entry.oracle_sql():
        assert differences(spark, con, name, SF_DIR) is None
    else:
        assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_the_count_reconciliation_reads_order_lines_at_most_twice(spark):
    plan = entry.queries()["reconcile_counts"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") <= 2
