"""What the driver gathers for a join does not grow with the tables."""

import pytest

from cleargrain.functions import fixed
from cleargrain.operators import audit, records, validate
from cleargrain.plans import analytics
from cleargrain.plans.staging import Staging
from cleargrain.plans.warehouse import StagedWarehouse, Warehouse


@pytest.fixture
def many(monkeypatch):
    """More rows than may be broadcast, in files that Spark takes for small."""
    monkeypatch.setattr(records, "_MOST_PARENTS", 2)
    return [{}, {}, {}, {}]


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def _joins(frame, kind):
    return sum(f"{kind} [" in line for line in _plan(frame).split("Initial Plan")[-1].splitlines())


def _named(key, prefix, rows):
    return [{key: f"{prefix}{n}"} for n, _ in enumerate(rows)]


@pytest.fixture
def warehouse(spark, make_sources, many, tmp_path):
    """Written and read back, as published tables are."""
    sources = make_sources(
        customers=_named("customer_id", "K", many), products=_named("product_id", "G", many),
        orders=[{"order_id": f"B{n}", "customer_id": f"K{n}", "product_id": f"G{n}"} for n in range(4)],
        support_tickets=[{"ticket_id": f"H{n}", "customer_id": f"K{n}"} for n in range(4)],
        finance_transactions=[{"finance_transaction_id": f"L{n}", "order_id": f"B{n // 2 * 2}"} for n in range(4)],
    )
    staging = Staging(spark, sources)
    tables = {}
    for name in ("dim_customer", "dim_product", "fact_order", "fact_support_ticket", "fact_finance_transaction"):
        StagedWarehouse(staging)[name].write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    return staging, Warehouse(tables)


def test_many_parents_are_not_broadcast(spark, many, rows, tmp_path):
    spark.range(9).selectExpr("concat('K', id) AS key", "id AS v").write.parquet(f"{tmp_path}/parents")
    parents = spark.read.parquet(f"{tmp_path}/parents")
    facts = spark.range(12).selectExpr("concat('R', id) AS record", "concat('K', id) AS ref")
    joined = records.lookup(facts, "ref", "record", parents, "key", {"v": "v"}, "found", spark.sql("SELECT 'K3' AS hot_key"))
    assert _joins(joined, "SortMergeJoin") == 1
    assert rows(joined.where("found"), "record", "v") == [(f"R{n}", n) for n in range(9)]
    assert joined.where("NOT found").count() == 3
    few = records.lookup(facts, "ref", "record", parents.where("v < 2"), "key", {"v": "v"}, "found", spark.sql("SELECT 'K3' AS hot_key"))
    assert _joins(few, "SortMergeJoin") == 0 and few.where("found").count() == 2


def test_invalid_references_count_the_parent_as_it_is(spark, many, rows):
    child = spark.range(5).selectExpr("concat('R', id) AS record", "concat('K', id) AS ref")
    parent = spark.range(3).selectExpr("concat('K', id % 1 + 1) AS key")
    wrong = records.invalid_references(child, "ref", parent, "key", "record")
    assert _joins(wrong, "SortMergeJoin") == 1 and rows(wrong, "value") == [("K0",), ("K2",), ("K3",), ("K4",)]


def test_more_hashes_than_are_broadcast_stay_off_the_driver(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(records, "_MOST_HASHES", 2)
    spark.range(3).selectExpr("id AS _hash").write.parquet(f"{tmp_path}/hashes")
    hashes = records.if_few(spark.read.parquet(f"{tmp_path}/hashes"))
    assert _joins(spark.range(9).selectExpr("id AS _hash").join(hashes, "_hash", "left_semi"), "SortMergeJoin") == 1


def test_staging_broadcasts_no_table(spark, warehouse):
    staging, _ = warehouse
    orders, customers, products = (staging.validated(name) for name in ("orders", "customers", "products"))
    judged = validate.validate_orders(staging.sources["orders"], customers, products, repeated=staging.repeated("orders"))
    assert _joins(judged, "SortMergeJoin") == 2
    assert judged.select("order_id", "customer_segment").exceptAll(orders.select("order_id", "customer_segment")).isEmpty()


def test_ledger_of_an_order_is_not_broadcast(warehouse, rows):
    staging, published = warehouse
    assert _joins(published.orders_with_ledger, "SortMergeJoin") == 3
    expected = [("B0", 30960, 2), ("B1", None, None), ("B2", 30960, 2), ("B3", None, None)]
    found = published.orders_with_ledger
    assert sorted((r["order_id"], r["net_cents"], r["ledger_rows"]) for r in found.collect()) == expected
    same = [row.asDict() for row in analytics.category_performance(StagedWarehouse(staging), grain_safe=True).collect()]
    assert same == [row.asDict() for row in analytics.category_performance(published, grain_safe=True).collect()]


def test_audits_and_reports_broadcast_no_table(warehouse, rows):
    _, published = warehouse
    audited = audit.reference_audit(published._given)
    assert _joins(audited, "SortMergeJoin") == 4
    assert rows(audited, "issue_count") == [(0,)] * 4
    assert _joins(analytics.finance_variance(published), "SortMergeJoin") == 1
    assert _joins(analytics.top_customers(published), "SortMergeJoin") == 3
    assert analytics.top_customers(published).count() == min(4, fixed.TOP_CUSTOMERS)
