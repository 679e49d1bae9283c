"""Every registered query against its SQL oracle, on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import connect, differences

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    assert differences(spark, con, SF, name, entry.queries(), entry.oracle_sql()) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
