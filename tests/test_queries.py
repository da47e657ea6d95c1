"""Every registered query runs on the smallest tables and agrees with its SQL, where it has one."""

from pathlib import Path

import pytest
from compare import compare, connect

from tidewatch.plans import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the supplied tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_agrees_with_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], SF_DIR) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry_points

    assert entry_points.entry(spark).count() == 5
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
