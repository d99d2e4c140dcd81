"""Driver contract: entry() and every registered query run on sf0.001."""

import __spark_entry__ as E
from conftest import SF_SMALL


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "ptid" in df.columns


def test_queries_have_oracles_and_run(spark):
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    for name in ["cohort_inner_join", "subject_split_sizes", "deid_plan", "tree_top4"]:
        assert qs[name](spark, SF_SMALL).count() >= 0


def test_plans_have_no_cross_joins_or_row_udfs(spark):
    banned = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
    for name, fn in E.queries().items():
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        found = [b for b in banned if b in plan]
        assert not found, (name, found)
