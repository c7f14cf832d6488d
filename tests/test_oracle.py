"""Every registered query against SQL over the same tables."""

import pytest

import __spark_entry__ as contract
from compare import check, connect

SF_DIR = "/root/testdata/sf0.001"
# Queries of the optional subpackage have their own tests.
OWN = set(contract.queries()) - set(contract.LLM_QUERIES)


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_only_unordered_limits_have_no_sql():
    assert OWN - set(contract.oracle_sql()) == {"peek_changes"}
    assert not set(contract.oracle_sql()) - set(contract.queries())


@pytest.mark.parametrize("name", sorted(OWN & set(contract.oracle_sql())))
def test_query(spark, tables, name):
    result = contract.queries()[name](spark, SF_DIR)
    assert check(result, tables, contract.oracle_sql()[name]) is None
    plan = result._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SortAggregate"):
        assert costly not in plan, costly


def test_entry_and_peek(spark):
    assert contract.entry(spark).count() > 0
    assert contract.queries()["peek_changes"](spark, SF_DIR).count() == 5


def test_filters_and_columns_reach_the_scan(spark):
    plan = contract.queries()["sales_metrics_tumbling"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,purchase)" in plan and "props" not in plan
    plan = contract.queries()["daily_store_view"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "l_linestatus" not in plan and "o_totalprice" not in plan
    # the fact is summed below the joins
    assert plan.index("Join") < plan.index("partial_sum(", plan.index("Join"))


def test_reconciliation_shuffles_once(spark):
    from tidemark.operators.quality import reconcile
    side = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    plan = reconcile(side, side, ["o_orderkey"], side.columns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
