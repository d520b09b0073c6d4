"""Every registered query with SQL beside it on the small tables."""

import os

import pytest

import __spark_entry__ as entry
from feedloom.checks import all_oracles, all_queries
from tests.compare import differences, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    """Those of the training-data operators that SQL cannot express have tests of their own."""
    assert set(all_queries()) == set(all_oracles())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, key):
    assert differences(entry.queries()[key](spark, SF_DIR), con, entry.oracle_sql()[key]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 64
