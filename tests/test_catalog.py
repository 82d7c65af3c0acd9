"""Every registered query against its SQL twin over whole tables."""

import pytest
from oracle import compare, duck

from netsift.plans import catalog

catalog.load()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, con, name):
    got, want = compare(spark, con, SF, catalog.QUERIES[name], catalog.ORACLES[name])
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).columns
