"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from samples.queries import ORACLE, QUERIES
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert differences(contract.queries()[name](spark, SF), con, contract.oracle_sql()[name]) == []


def test_entry_returns_the_features(spark):
    df = contract.entry(spark)
    assert df.columns == ["part", "name", "reason", "gui", "hab_type", "sum_conf", "comp", "wkb"] and df.count() > 0
