"""Every registered query against its DuckDB SQL twin at sf0.01."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck
from visitflow.plans import catalog

from paths import SF_ORACLE

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_sql():
    assert set(catalog.queries()) <= set(SQL) <= set(QUERIES)


# plan shapes that break at scale; the visit analytics need none of them
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
             "MapInArrow", "FlatMapGroupsInPandas", "PythonMapInArrow")


@pytest.mark.parametrize("name", sorted(n for n in SQL if not n.startswith("whole_")))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_ORACLE)
    if name in catalog.queries():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [op for op in FORBIDDEN if op in plan]
    ok, n, _, _, why = compare(spark, con, name, lambda spark, d: df, SQL[name], SF_ORACLE)
    assert ok, why


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 1
    assert df.columns[0] == "session_count"
