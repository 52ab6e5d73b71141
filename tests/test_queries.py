"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.oracles import all_oracles
from checks.queries import all_queries
from checks.run import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(all_oracles()) == set(all_queries())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, duck, name):
    got = all_queries()[name](spark, SF).toPandas()
    assert len(got) > 0
    assert compare(got, duck.execute(all_oracles()[name]).df()) == "ok"


def test_entry(spark):
    assert contract.entry(spark).count() > 0
    assert set(all_queries()) <= set(contract.queries())
    assert set(all_oracles()) <= set(contract.oracle_sql()) <= set(contract.queries())
