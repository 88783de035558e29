"""Every registered query against its SQL twin, or for non-empty output where it has none."""

import pytest

from oracle import connect, differences
from tidewatch.plans.catalogue import ORACLES, QUERIES

# No cross joins and no Python in any plan.
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"]


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, con, name):
    result = QUERIES[name](spark, folder)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert [x for x in FORBIDDEN if x in plan] == []
    if name in ORACLES:
        assert differences(result, con, ORACLES[name]) == []
    else:
        assert result.count() > 0


def test_entry_shape(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).columns == ["service", "anomaly_rate", "connections"]
    assert set(oracle_sql()) <= set(queries())
