"""Every registered query: its plan, and its rows against its SQL."""

import os

import oracle
import pytest

import __spark_entry__ as entry_module

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES = {name: entry_module.queries()[name] for name in entry_module.CORE_QUERIES}
SQL = {name: sql for name, sql in entry_module.oracle_sql().items() if name in QUERIES}
NOT_IN_A_PLAN = [
    "CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "InPandas"
]


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = oracle.plan_of(df)
    assert [word for word in NOT_IN_A_PLAN if word in plan] == []
    assert oracle.differences(df, con, SQL[name]) == []


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["tbl", "id"]
    assert df.count() > 0
