"""Every registered query against its SQL on the driver tables."""

from pathlib import Path

import pytest
from compare import compare, connect

from supplyview.plans.oracle import ORACLE_SQL
from supplyview.plans.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(con, QUERIES[name](spark, str(SF_DIR)), ORACLE_SQL[name]) == []


def test_entry_is_the_pivot_with_totals(spark):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert df.columns[0] == "category" and "TOTAL" in df.columns
    assert df.filter("category = 'TOTAL'").count() == 1
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())
