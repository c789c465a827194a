"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as contract
from checks.compare import difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert difference(spark, SMALL, name) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["DependencySourceType", "DependencyTargetType", "n_edges"]
    assert df.count() > 0
