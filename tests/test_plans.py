"""Column pruning and filter pushdown, read from the physical plans."""

from tidewatch.plans.catalogue import QUERIES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_they_use(spark, folder):
    plan = plan_of(QUERIES["class_imbalance"](spark, folder))
    assert "ReadSchema: struct<o_orderpriority:string>" in plan
    plan = plan_of(QUERIES["auc_exact"](spark, folder))
    assert "ReadSchema: struct<l_discount:double,l_tax:double,l_returnflag:string>" in plan


def test_filters_reach_the_scan(spark, folder):
    plan = plan_of(QUERIES["service_risk_top15"](spark, folder))
    assert "PushedFilters: [IsNotNull(l_partkey)]" in plan
