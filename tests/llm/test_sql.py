"""Registered queries against their SQL on the smallest data, and all of them for a stable contract."""

import pytest

import __spark_entry__ as contract
from changeloom.llm.queries import QUERIES
from oracle import connect, spark_rows, sql_rows, type_differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query(spark, name):
    con, q = connect(SF), QUERIES[name]
    df = q.plan(spark, SF)
    names, got = spark_rows(df)
    wanted_names, wanted = sql_rows(con, q.sql)
    assert names == wanted_names
    assert type_differences(con, df, q.sql) == []
    assert got == wanted


def test_registered():
    names = set(contract.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {n.split("_")[0] + "_" for n in names if n.startswith("op")} | {"op_"}
    assert "pipeline" in names
