import pytest
from pyspark.sql import functions as F

from cleargrain.operators import audit
from cleargrain.operators.reconcile import DataQualityError, reconcile, require_balanced
from cleargrain.plans.staging import Staging
from cleargrain.plans.warehouse import StagedWarehouse, open_latest, publish, reconciliation
from cleargrain.sources import schemas


@pytest.fixture(scope="module")
def mixed(spark, make_sources):
    """Loaded, standardized, quarantined and cascaded records together."""
    staging = Staging(spark, make_sources(
        customers=[{}, {"customer_id": "K-202", "region": " ", "customer_segment": "Mid Market"},
                   {"customer_id": "K-203", "region": ""}],
        orders=[
            {}, {}, {"order_id": "B-902", "customer_id": "UNKNOWN", "order_status": "complete"},
            {"order_id": "B-903", "quantity": "2.0", "channel": " online", "order_status": "canceled"},
            {"order_id": "B-904", "order_amount": "100000.50", "customer_id": "K-202"},
        ],
        support_tickets=[
            {}, {"ticket_id": "H-52", "resolved_at": "", "ticket_status": "open", "satisfaction_score": ""},
            {"ticket_id": "H-53", "customer_id": "", "opened_at": "bad"},
        ],
        finance_transactions=[
            {}, {"finance_transaction_id": "L-7002", "order_id": "B-902"},
            {"finance_transaction_id": "L-7003", "order_id": "B-903", "transaction_amount": "0", "transaction_type": "Adjustment"},
            {"finance_transaction_id": "L-7004", "order_id": "B-904", "transaction_amount": "1"},
            {"finance_transaction_id": "L-7005", "order_id": "", "posted_date": ""},
        ],
    ))
    return staging, StagedWarehouse(staging)


def test_clean_sources_raise_no_issue(spark, make_sources, rows):
    staging = Staging(spark, make_sources())
    assert staging.issues().count() == 0
    staging.require_no_critical()
    statuses = rows(staging.controls(), "control", "status", "issue_count")
    assert len(statuses) == 5 and {status for _, status, _ in statuses} == {"PASS"}
    assert {row.status for row in reconciliation(staging, StagedWarehouse(staging)).collect()} == {"PASS"}


def test_routing_and_flags(mixed, rows):
    _, wh = mixed
    assert rows(wh["fact_order"], "order_id", "quantity", "order_status", "channel", "order_month", "quality_flag") == [
        ("B-901", 3, "SHIPPED", "PARTNER", "2024-06", "DUPLICATE_BUSINESS_KEY"),
        ("B-903", 2, "CANCELLED", "ONLINE", "2024-06", "CATEGORY_STANDARDIZED"),
        ("B-904", 3, "SHIPPED", "PARTNER", "2024-06", "UNUSUAL_NUMERIC_VALUE"),
    ]
    assert rows(wh["order_quarantine"]) == [
        ("B-902", "UNKNOWN", "G-31", "2024-06-07", 15480, "CATEGORY_STANDARDIZED|INVALID_CUSTOMER_REFERENCE")
    ]
    assert rows(wh["dim_customer"], "customer_id", "region", "customer_segment", "quality_flag") == [
        ("K-201", "WEST", "ENTERPRISE", "PASS"),
        ("K-202", "UNKNOWN", "MID_MARKET", "CATEGORY_STANDARDIZED"),
        ("K-203", "UNKNOWN", "ENTERPRISE", "MISSING_REGION"),
    ]
    assert rows(wh["fact_support_ticket"], "ticket_id", "resolution_hours", "satisfaction_score", "resolved_at")[0] == (
        "H-51", 3.5, 4, "2024-06-10T12:45")
    assert wh["fact_support_ticket"].where("ticket_id = 'H-52'").first().resolved_at is None
    assert rows(wh["support_ticket_quarantine"]) == [
        ("H-53", None, "bad", "INVALID_CUSTOMER_REFERENCE|MALFORMED_DATE")
    ]


def test_cascade_and_ledger(mixed, rows):
    _, wh = mixed
    assert [r[0] for r in rows(wh["fact_finance_transaction"], "finance_transaction_id")] == ["L-7001", "L-7003", "L-7004"]
    assert rows(wh["finance_transaction_quarantine"], "finance_transaction_id", "order_id", "quarantine_reason") == [
        ("L-7002", "B-902", "ORDER_NOT_LOADED"),
        ("L-7005", None, "INVALID_ORDER_REFERENCE|MALFORMED_DATE"),
    ]
    flags = dict(rows(wh["fact_finance_transaction"], "finance_transaction_id", "quality_flag"))
    assert flags["L-7004"] == "FINANCE_ORDER_AMOUNT_MISMATCH"


def test_exceptions_follow_emission_order(mixed):
    staging, _ = mixed
    listed = [
        (row.exception_id, row.dataset, row.record_id, row.issue_type)
        for row in staging.exceptions().orderBy("exception_id").collect()
    ]
    assert listed[0] == ("DQ000001", "orders", "B-901", "DUPLICATE_BUSINESS_KEY")
    assert listed[1] == ("DQ000002", "customers", "K-202", "CATEGORY_STANDARDIZED")
    assert listed[-1][1:] == ("finance_transactions", "L-7002", "ORDER_NOT_LOADED")
    assert [entry[0] for entry in listed] == [f"DQ{n:06d}" for n in range(1, len(listed) + 1)]
    order = ["customers", "products", "orders", "support_tickets", "finance_transactions"]
    middle = [order.index(entry[1]) for entry in listed[1:-1]]
    assert middle == sorted(middle)


def test_counts_and_controls(mixed, rows):
    staging, _ = mixed
    counts = {row.dataset: tuple(row)[1:] for row in staging.counts().collect()}
    assert counts["orders"] == (5, 4, 3, 1, 1)
    assert counts["finance_transactions"] == (5, 5, 3, 2, 0)
    controls = {(row.dataset, row.control): (row.issue_count, row.status) for row in staging.controls().collect()}
    assert controls["finance_transactions", "ORDER_NOT_LOADED"] == (1, "WARNING")
    assert controls["enterprise", "CRITICAL_ERROR_THRESHOLD"] == (0, "PASS")


def test_publish_and_reopen(spark, mixed, folder, rows):
    staging, wh = mixed
    publish(staging, folder, "first")
    again = open_latest(spark, folder)
    for name in schemas.WAREHOUSE:
        left, right = wh[name], again[name]
        assert left.columns == right.columns
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty(), name
    assert rows(again.enriched_orders, "order_id", "product_category") == rows(
        wh.enriched_orders, "order_id", "product_category")
    plan = again["fact_order"].where("order_month = '2023-12'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan


def test_failed_run_keeps_the_last_version(spark, mixed, make_sources, folder):
    staging, _ = mixed
    publish(staging, folder, "good")
    broken = Staging(spark, make_sources(customers=[{}, {"customer_id": ""}]))
    with pytest.raises(DataQualityError, match="customers/MISSING_KEY: customer_id is required"):
        publish(broken, folder, "broken")
    assert open_latest(spark, folder)["fact_order"].count() == 3


def test_unreadable_amount_stops_publication(spark, make_sources, folder):
    staging = Staging(spark, make_sources(orders=[{}, {"order_id": "B-902", "order_amount": "n/a"}]))
    with pytest.raises(DataQualityError, match="orders_amount_cents"):
        publish(staging, folder, "unreadable")


def test_values_outside_table_domains_stop_publication(spark, make_sources, folder):
    staging = Staging(spark, make_sources(
        orders=[{}, {"order_id": "B-902", "channel": "FAX"}],
        support_tickets=[{}, {"ticket_id": "H-52", "satisfaction_score": "often"}],
    ))
    with pytest.raises(DataQualityError, match="fact_order.channel DOMAIN: 1.*satisfaction_score RANGE: 1"):
        publish(staging, folder, "outside")


def test_reconcile_compares_counts_and_cents(spark, rows):
    source = spark.createDataFrame([("B-1", "72.25"), ("B-2", "0.75"), ("B-3", "19")], "id string, amount string")
    loaded = spark.createDataFrame([(7225,), (1900,)], "amount_cents bigint")
    held = spark.createDataFrame([(75,)], "amount_cents bigint")
    good = reconcile("ledger", source, loaded, held, "amount", "amount_cents")
    assert rows(good, "control_name", "source_value", "difference", "status") == [
        ("ledger_amount_cents", 9200, 0, "PASS"), ("ledger_count", 3, 0, "PASS")]
    require_balanced(good)
    short = reconcile("ledger", source, loaded, held.limit(0), "amount", "amount_cents")
    assert rows(short, "control_name", "difference") == [("ledger_amount_cents", 75), ("ledger_count", 1)]
    with pytest.raises(DataQualityError, match="ledger_amount_cents, ledger_count"):
        require_balanced(short)


def test_a_row_lost_on_the_way_to_staging_fails_its_controls(spark, make_sources, rows):
    staging = Staging(spark, make_sources(orders=[{}, {"order_id": "B-902", "order_amount": "10.00"}]))
    kept = staging.validated
    staging.validated = lambda name: kept(name).where("order_id <> 'B-902'") if name == "orders" else kept(name)
    failed = reconciliation(staging, StagedWarehouse(staging)).where("status = 'FAIL'")
    assert rows(failed, "control_name", "difference") == [("orders_amount_cents", 1000), ("orders_count", 1)]


def test_audits_find_planted_damage(spark, mixed):
    _, wh = mixed
    tables = wh.tables
    tables["fact_order"] = tables["fact_order"].union(tables["fact_order"]).withColumn(
        "customer_id", F.when(F.col("order_id") == "B-903", "GONE").otherwise(F.col("customer_id"))
    )
    repeated = {row.table_name: row.repeated_keys for row in audit.key_audit(tables).collect()}
    assert repeated["fact_order"] == 3 and repeated["dim_customer"] == 0
    orphans = {row.control_name: row.issue_count for row in audit.reference_audit(tables).collect()}
    assert orphans["ORDER_CUSTOMER_FK"] == 2 and orphans["FINANCE_ORDER_FK"] == 0


def test_rerun_gives_the_same_tables(spark, make_sources):
    changes = {"orders": [{}, {"order_id": "B-902", "quantity": "x"}, {"order_id": "B-902"}]}
    first, second = (StagedWarehouse(Staging(spark, make_sources(**changes))) for _ in range(2))
    for name in schemas.WAREHOUSE:
        assert first[name].exceptAll(second[name]).isEmpty(), name
