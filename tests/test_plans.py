"""What the physical plans must and must not contain."""

import os

import pytest

from cleargrain.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_no_query_multiplies_rows_or_leaves_the_jvm(spark):
    for name, query in QUERIES.items():
        plan = plan_of(query(spark, SF))
        for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
            assert unwanted not in plan, (name, unwanted)


@pytest.mark.parametrize("name", ["top_customers", "profile_top_values"])
def test_row_limits_apply_before_the_shuffle(spark, name):
    assert "row_number(), " in plan_of(QUERIES[name](spark, SF))
    assert "Partial" in plan_of(QUERIES[name](spark, SF)).split("WindowGroupLimit", 2)[2]


def test_analytics_read_only_the_columns_they_use(spark):
    plan = plan_of(QUERIES["kpi_finance"](spark, SF))
    assert "FileScan parquet [transaction_amount_cents" in plan
    assert "source_amount" not in plan and "finance_transaction_id" not in plan
