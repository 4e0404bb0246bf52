"""Plan audits: no registered query compiles to a cartesian product or a
nested-loop join, and filters/projections reach the Parquet scan."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

KEYS = sorted(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_no_cross_join(spark, key):
    plan = E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pushdown_and_pruning(spark):
    df = E.queries()["filter_in_set"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(o_orderpriority" in plan or "In(o_orderpriority" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in plan
