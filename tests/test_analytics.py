import pytest

from cleargrain.plans import analytics, reports
from cleargrain.plans.warehouse import Warehouse
from cleargrain.sources import schemas


def warehouse(spark, **tables):
    base = {
        "dim_customer": [("K-1", "Harbor Lane Bakery", "SMB", "WEST", "2023-11-20", "INACTIVE", "PASS"),
                         ("K-2", "Quiet Mill", "ENTERPRISE", "SOUTH", "2023-02-02", "ACTIVE", "PASS")],
        "dim_product": [("G-1", "Ledger Sync", "CLOUD", 7250, 1900, "N", "PASS")],
        "fact_order": [
            ("B-1", "K-1", "G-1", "2024-06-07", "2024-06", 3, 7250, 0, 21750, "SHIPPED", "PARTNER", "PASS"),
            ("B-2", "K-1", "G-1", "2024-06-21", "2024-06", 2, 7250, 0, 14500, "COMPLETED", "DIRECT", "PASS"),
            ("B-3", "K-1", "G-1", "2024-06-25", "2024-06", 1, 7250, 0, 7250, "CANCELLED", "ONLINE", "PASS"),
        ],
        "fact_finance_transaction": [
            ("L-1", "B-1", "2024-06-09", "2024-06", "SALE", 21750, "USD", "POSTED", "PASS"),
            ("L-2", "B-2", "2024-06-23", "2024-06", "SALE", 14500, "USD", "PENDING", "PASS"),
            ("L-3", "B-3", "2024-06-26", "2024-06", "ADJUSTMENT", -250, "USD", "POSTED", "PASS"),
        ],
        "fact_support_ticket": [
            ("H-1", "K-1", "2024-06-10T09:15", "2024-06", "2024-06-10T12:45", "CLOSED", "MEDIUM", "BILLING", 3.5, 4, "PASS"),
            ("H-2", "K-1", "2024-06-11T08:00", "2024-06", "2024-06-15T08:00", "CLOSED", "HIGH", "BILLING", 96.0, 1, "PASS"),
        ],
    }
    base.update(tables)
    return Warehouse({name: spark.createDataFrame(data, schemas.WAREHOUSE[name]) for name, data in base.items()})


def score_of(spark, total, quarantined, critical, remediated):
    inputs = spark.createDataFrame(
        [(total, quarantined, critical, remediated, critical + remediated)],
        "total_records bigint, quarantined_records bigint, critical_issues bigint,"
        " remediated_issues bigint, exception_count bigint",
    )
    return analytics.quality_score(inputs)


@pytest.mark.parametrize("inputs, expected", [
    ((100, 0, 0, 0), 100.0), ((100, 2, 0, 1), 96.75), ((100, 100, 0, 0), 0.0),
    ((0, 0, 0, 0), 0.0), ((19820, 174, 0, 369), 98.22), ((100, 0, 1, 0), 95.0),
])
def test_quality_score(spark, inputs, expected):
    assert score_of(spark, *inputs).first().data_quality_score == expected


def test_overall_kpis(spark):
    kpis = analytics.kpi_overall(warehouse(spark), score_of(spark, 40, 1, 0, 2))
    row = kpis.first()
    # Posted 217.50 and -2.50; fulfilled 217.50 and 145.00 over two orders; one of three cancelled.
    assert (row.net_revenue, row.fulfilled_order_value, row.average_order_value) == (215.0, 362.5, 181.25)
    assert (row.order_count, row.cancellation_rate, row.pending_finance_transactions) == (3, 33.33, 1)
    # 3.5 of 72 hours, 96 of 48 hours.
    assert (row.ticket_volume, row.ticket_sla_rate, row.average_resolution_hours) == (2, 50.0, 49.75)
    assert row.data_quality_score == 95.0  # (40 - 1.5 - 0.5) / 40
    assert len(reports.kpi_summary(kpis).collect()) == 14


def test_several_ledger_rows_fan_out_unless_grain_safe(spark):
    ledger = [
        ("L-1", "B-1", "2024-06-12", "2024-06", "SALE", 20000, "USD", "POSTED", "PASS"),
        ("L-2", "B-1", "2024-06-08", "2024-06", "SALE", 1250, "USD", "POSTED", "PASS"),
        ("L-3", "B-1", "2024-06-10", "2024-06", "SALE", 700, "USD", "PENDING", "PASS"),
    ]
    wh = warehouse(spark, fact_finance_transaction=ledger)
    fanned = analytics.category_performance(wh).first()  # B-1 counts three times
    assert (fanned.order_count, fanned.units_sold, fanned.fulfilled_order_value, fanned.net_revenue) == (5, 12, 797.5, 212.5)
    safe = analytics.category_performance(wh, grain_safe=True).first()
    assert (safe.order_count, safe.units_sold, safe.fulfilled_order_value, safe.net_revenue) == (3, 6, 362.5, 212.5)
    month = analytics.dashboard_dataset(wh).first()
    assert (month.order_count, month.average_order_value, month.cancellation_rate) == (5, 199.38, 20.0)
    first = analytics.finance_variance(wh).first()
    assert (first.finance_transaction_id, first.variance_cents) == ("L-2", -20500)


def test_months_use_order_months_as_spine(spark):
    def order(n, month, cents, status="COMPLETED"):
        return (f"O{n}", "K-1", "G-1", f"{month}-01", month, 1, cents, 0, cents, status, "DIRECT", "PASS")

    def posted(n, month, cents):
        return (f"F{n}", f"O{n}", f"{month}-02", month, "SALE", cents, "USD", "POSTED", "PASS")

    wh = warehouse(
        spark,
        fact_order=[order(1, "2025-01", 1000), order(2, "2025-02", 2000), order(3, "2025-03", 3000)],
        fact_finance_transaction=[posted(1, "2025-02", 1000), posted(2, "2025-04", 5000), posted(3, "2025-03", -500)],
    )
    months = analytics.monthly_trends(wh).orderBy("reporting_month").collect()
    assert [row.net_revenue for row in months] == [0.0, 10.0, -5.0]
    assert [row.revenue_mom_growth_pct for row in months] == [None, None, -150.0]
    assert [row.ticket_volume for row in months] == [0, 0, 0]
    assert [row.ticket_sla_rate for row in months] == [0.0, 0.0, 0.0]
    assert [row.revenue_zscore for row in months] == [-0.27, 1.34, -1.07]
    growth = analytics.mom_growth(wh).orderBy("reporting_month").collect()
    assert [row.revenue_growth_pct for row in growth] == [None, None, -150.0]
    assert [row.order_growth_pct for row in growth] == [None, 0.0, 0.0]


def test_single_month_has_no_spread(spark):
    row = analytics.monthly_trends(warehouse(spark)).first()
    assert (row.revenue_zscore, row.revenue_anomaly_flag, row.revenue_mom_growth_pct) == (0.0, "N", None)


def test_segments_without_orders_stay(spark):
    wh = warehouse(spark)
    assert [tuple(r) for r in analytics.segment_metrics(wh).collect()] == [
        ("SMB", 3, 1, 362.5, 181.25, 1), ("ENTERPRISE", 0, 0, 0.0, 0.0, 0)]
    assert analytics.segment_having(wh).isEmpty()


def test_listings_come_in_their_order(spark):
    """Listings are sorted as their readers expect, also where the sort key is no column."""
    kinds = ("LOW", "CRITICAL", "MEDIUM", "HIGH")
    tickets = [(f"H-{n}", "K-1", "2024-06-10T09:15", "2024-06", None, "OPEN", kind, "BILLING", None, None, "PASS")
               for n, kind in enumerate(kinds)]
    amounts = {"B-1": 21750, "B-2": 14500 - 90, "B-3": 700}
    ledger = [(f"L-{n}", order, "2024-07-01", "2024-07", "SALE", cents, "USD", "POSTED", "PASS")
              for n, (order, cents) in enumerate(amounts.items())]
    wh = warehouse(spark, fact_support_ticket=tickets, fact_finance_transaction=ledger)
    assert [r.priority for r in analytics.sla_by_priority(wh).collect()] == ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
    assert [(r.order_id, r.variance_cents) for r in analytics.finance_variance(wh).collect()] == [("B-3", 700), ("B-2", -90)]
    counts = spark.createDataFrame(
        [("orders", "A", "LOW", "REVIEW", 3), ("orders", "B", "LOW", "REVIEW", 9), ("customers", "C", "LOW", "REVIEW", 3)],
        "dataset string, issue_type string, severity string, action string, issue_count bigint")
    assert [(r.dataset, r.exception_count) for r in analytics.exception_summary(counts).collect()] == [
        ("orders", 9), ("customers", 3), ("orders", 3)]
    assert [(r.dataset, r.issue_rank) for r in analytics.exception_rank(counts).collect()] == [
        ("customers", 1), ("orders", 1), ("orders", 2)]


def test_top_customers_keep_ties_in_rank(spark, rows):
    customers = [(f"C{n}", f"Name {n}", "SMB", "EAST", "2025-01-01", "ACTIVE", "PASS") for n in range(8)]
    values = [50, 70, 70, 10, 70, 50, 20, 5]
    orders = [(f"O{n}", f"C{n}", "G-1", "2025-01-02", "2025-01", 1, v, 0, v, "SHIPPED", "DIRECT", "PASS")
              for n, v in enumerate(values)]
    best = analytics.top_customers(warehouse(spark, dim_customer=customers, fact_order=orders))
    assert rows(best, "row_number", "customer_id", "value_rank") == [
        (1, "C1", 1), (2, "C2", 1), (3, "C4", 1), (4, "C0", 4), (5, "C5", 4)]


def test_highlights_break_ties_by_listing_order(spark, rows):
    wh = warehouse(spark)
    assert rows(analytics.highlights(wh), "highlight", "name") == [
        ("highest_revenue_month", "2024-06"), ("lowest_sla_month", "2024-06"),
        ("top_category", "CLOUD"), ("top_segment", "SMB")]


def test_empty_warehouse_gives_zero_kpis_and_no_months(spark):
    wh = warehouse(spark, **{name: [] for name in (
        "dim_customer", "dim_product", "fact_order", "fact_finance_transaction", "fact_support_ticket")})
    row = analytics.kpi_overall(wh, score_of(spark, 0, 0, 0, 0)).first()
    assert (row.net_revenue, row.order_count, row.ticket_sla_rate, row.data_quality_score) == (0.0, 0, 0.0, 0.0)
    assert analytics.monthly_trends(wh).isEmpty()


def test_findings_follow_their_rules(spark):
    wh = warehouse(spark)
    kinds = "dataset string, issue_type string, severity string, action string, issue_count bigint"
    none = spark.createDataFrame([], kinds)
    months = analytics.monthly_trends(wh)
    calm_ticket = ("H-1", "K-1", "2024-06-10T09:15", "2024-06", "2024-06-10T12:45", "CLOSED", "MEDIUM", "BILLING", 3.5, 4, "PASS")
    calm = analytics.kpi_overall(
        warehouse(spark, fact_support_ticket=[calm_ticket], fact_order=[
            ("B-1", "K-1", "G-1", "2024-06-07", "2024-06", 3, 7250, 0, 21750, "SHIPPED", "PARTNER", "PASS")]),
        score_of(spark, 7, 0, 0, 0))
    assert [tuple(r) for r in reports.findings(calm, none, months).collect()] == [
        (1, "Continue monthly monitoring of quality controls, revenue, orders, and support performance.")]
    issues = spark.createDataFrame([
        ("orders", "INVALID_CUSTOMER_REFERENCE", "HIGH", "QUARANTINE", 4),
        ("orders", "INVALID_PRODUCT_REFERENCE", "HIGH", "QUARANTINE", 3)], kinds)
    overall = analytics.kpi_overall(wh, score_of(spark, 100, 2, 0, 1))
    texts = [r.finding for r in reports.findings(overall, issues, months).orderBy("finding_no").collect()]
    assert texts == [
        "Track remediation by source owner until the issue-weighted quality score improves from 96.75%.",
        "Add master-data validation at ingestion for the 7 invalid customer/product references detected"
        " across operational sources.",
        "Review staffing and escalation rules because only 50.00% of eligible tickets met the priority-based SLA.",
        "Analyze cancellation drivers by channel and segment; the current rate is 33.33%.",
    ]
