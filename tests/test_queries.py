"""Every query of the library against its oracle SQL."""

import os

import pytest

from loomwork.plans import catalogue
from tests.oracle import assert_same, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    df = catalogue.QUERIES[name](spark, SF)
    if name in catalogue.ORACLE_SQL:
        assert_same(df, con, catalogue.ORACLE_SQL[name])
    else:
        assert df.count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
