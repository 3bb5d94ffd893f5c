"""Every registered query agrees with its SQL on the smallest tables."""

import os

import pytest
from check import compare, oracle

from flowtables.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_every_query_has_sql():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == set()


def test_entry(spark):
    from __spark_entry__ import entry

    assert not entry(spark).isEmpty()


@pytest.mark.parametrize(
    "name",
    ["route_batches", "route_by_shuffle", "unroutable", "fan_out_recipients", "fan_out_inboxes", "settle",
     "log_resume", "directory_changes", "csv_header_row", "csv_files", "queue_after_receive", "apply_actions"],
)
def test_no_cross_joins(spark, name, capsys):
    QUERIES[name](spark, SF_DIR).explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_receive_limits_rows_before_the_shuffle(spark, capsys):
    QUERIES["queue_receive"](spark, SF_DIR).explain()
    plan = capsys.readouterr().out
    assert "row_number(), 10, Partial" in plan[plan.index("Exchange") :]
