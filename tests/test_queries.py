"""Every registered query against its SQL check on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
#: Those of the optional subpackage have their own tests and may use Python.
LLM = set(entry.LLM_QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_checks_and_queries_belong_together():
    assert set(SQL) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 230


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - LLM))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in LLM:
        assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan
    if name in SQL:
        assert compare(df, con, SQL[name]) == []
    else:
        assert df.count() > 0
