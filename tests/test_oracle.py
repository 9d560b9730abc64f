"""Every registered query against its SQL, on the smallest data."""

import pytest

import __spark_entry__ as contract
from changeloom.plans import QUERIES
from oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(con, spark, name):
    # Some conditions are met by no row of the smallest data; the driver checks larger data.
    assert [d for d in differences(con, spark, name, SF) if d != "no rows"] == []


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["date", "total_amount", "order_count"]
