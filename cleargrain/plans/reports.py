"""Report tables: KPI list, findings, control outcomes, headline facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleargrain.functions import fixed
from cleargrain.functions.measure import decimal_text, sum_if, title_text
from cleargrain.functions.unfold import quoted, unfold
from cleargrain.plans.analytics import one_row


def kpi_summary(overall: DataFrame) -> DataFrame:
    """The headline row as a list: name, value, unit, definition."""
    entries = [
        {
            "kpi_name": quoted(name), "kpi_value": f"CAST({name} AS DOUBLE)", "unit": quoted(unit),
            "definition": quoted(definition),
        }
        for name, unit, definition in fixed.KPIS
    ]
    return unfold(overall, entries)


def issue_type_counts(issue_counts: DataFrame) -> DataFrame:
    return issue_counts.groupBy("issue_type").agg(F.sum("issue_count").alias("issue_count"))


def top_issues(issue_counts: DataFrame) -> DataFrame:
    """The most frequent kinds of finding, ties by name, with a readable label."""
    return (
        issue_type_counts(issue_counts)
        .orderBy(F.desc("issue_count"), "issue_type")
        .limit(fixed.TOP_ISSUES)
        .select("issue_type", title_text(F.col("issue_type")).alias("label"), "issue_count")
    )


def control_outcomes(controls: DataFrame) -> DataFrame:
    """Controls passed, warned and failed; an outcome that never occurs shows zero."""
    counted = controls.agg(
        *[F.count(F.when(F.col("status") == status, 1)).alias(status) for status in ("PASS", "WARNING", "FAIL")]
    )
    return counted.unpivot([], ["PASS", "WARNING", "FAIL"], "status", "control_count")


def publish_status(issue_counts: DataFrame, reconciliation: DataFrame) -> DataFrame:
    """PASS when nothing critical was found and every reconciliation balances."""
    critical = issue_counts.agg(
        sum_if(F.col("action") == "FAIL_PIPELINE", F.col("issue_count")).alias("critical_errors")
    )
    failed = reconciliation.agg(
        F.count(F.when(F.col("status") != "PASS", 1)).alias("failed_reconciliations"),
        F.count(F.lit(1)).alias("reconciliations"),
    )
    passed = (F.col("critical_errors") == 0) & (F.col("failed_reconciliations") == 0)
    return one_row(critical, failed).select(
        "critical_errors", "failed_reconciliations", "reconciliations",
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
    )


def findings(overall: DataFrame, issue_counts: DataFrame, months: DataFrame) -> DataFrame:
    """Numbered recommendations, each raised by its own rule over one row of facts."""
    hits = F.col("issue_count")
    references = ("INVALID_CUSTOMER_REFERENCE", "INVALID_PRODUCT_REFERENCE")
    issues = issue_counts.agg(
        sum_if(F.col("issue_type").isin(*references), hits).alias("bad_references"),
        sum_if(F.col("issue_type") == "FINANCE_ORDER_AMOUNT_MISMATCH", hits).alias("mismatches"),
    )
    # One short text per unusual calendar month.
    unusual = months.where("revenue_anomaly_flag = 'Y'").agg(
        F.array_join(F.array_sort(F.collect_list("reporting_month")), ", ").alias("unusual_months")
    )
    facts = one_row(overall, issues, unusual)
    score, sla, cancelled = (
        F.col(name) for name in ("data_quality_score", "ticket_sla_rate", "cancellation_rate")
    )

    def say(text: str, *values: Column) -> Column:
        return F.format_string(text, *values)

    # Wording and thresholds of the findings, in listing order.
    rules = (
        (score < 99, say(
            "Track remediation by source owner until the issue-weighted quality score improves from %s%%.",
            decimal_text(score))),
        (F.col("bad_references") > 0, say(
            "Add master-data validation at ingestion for the %d invalid customer/product references"
            " detected across operational sources.", F.col("bad_references"))),
        (F.col("mismatches") > 0, say(
            "Route the %d order-to-ledger amount differences to finance reconciliation before period close.",
            F.col("mismatches"))),
        (sla < 90, say(
            "Review staffing and escalation rules because only %s%% of eligible tickets met the"
            " priority-based SLA.", decimal_text(sla))),
        (cancelled >= 8, say(
            "Analyze cancellation drivers by channel and segment; the current rate is %s%%.",
            decimal_text(cancelled))),
        (F.col("unusual_months") != "", say(
            "Investigate revenue mix and postings for statistically unusual month(s): %s.",
            F.col("unusual_months"))),
    )
    nothing = "Continue monthly monitoring of quality controls, revenue, orders, and support performance."
    raised = F.array_compact(F.array(*[F.when(hit, text) for hit, text in rules]))
    listed = F.when(F.size(raised) > 0, raised).otherwise(F.array(F.lit(nothing)))
    return facts.select(F.posexplode(listed).alias("at", "finding")).select(
        (F.col("at") + 1).cast("bigint").alias("finding_no"), "finding"
    )


def report_facts(
    overall: DataFrame, profile: DataFrame, issue_counts: DataFrame, controls: DataFrame,
    reconciliation: DataFrame, categories: DataFrame, segments: DataFrame, months: DataFrame,
) -> DataFrame:
    """Every number the narrative report states, as readable text per section."""
    def best(frame: DataFrame, prefix: str, order: Column, name: str, **values: str) -> DataFrame:
        return frame.orderBy(order, F.col(name).asc()).limit(1).select(
            F.col(name).alias(f"{prefix}_name"),
            *[F.col(column).alias(f"{prefix}_{alias}") for alias, column in values.items()],
        )

    outcome = controls.agg(
        *[F.count(F.when(F.col("status") == status, 1)).alias(f"controls_{status.lower()}")
          for status in ("PASS", "WARNING", "FAIL")]
    )
    row = one_row(
        overall, profile, outcome,
        publish_status(issue_counts, reconciliation).select(
            "critical_errors", "reconciliations",
            F.when(F.col("failed_reconciliations") == 0, "PASS").otherwise("FAIL").alias("balanced"),
        ),
        best(categories, "category", F.desc("net_revenue"), "product_category",
             value="net_revenue", orders="order_count", units="units_sold"),
        best(segments, "segment", F.desc("fulfilled_order_value"), "customer_segment",
             value="fulfilled_order_value", orders="order_count"),
        best(months, "best_month", F.desc("net_revenue"), "reporting_month", value="net_revenue"),
        best(months, "worst_month", F.asc("ticket_sla_rate"), "reporting_month", rate="ticket_sla_rate"),
    )

    def number(name: str) -> str:
        return f"format_number({name}, 0)"

    def money(name: str) -> str:
        return f"'$' || format_number({name}, 2)"

    def rate(name: str) -> str:
        return f"format_string('%.2f', {name})"

    # Section, fact and how the fact reads.
    facts = (
        ("executive_summary", "raw_rows", number("rows_profiled")),
        ("executive_summary", "net_revenue", money("net_revenue")),
        ("executive_summary", "loaded_orders", number("order_count")),
        ("executive_summary", "data_quality_score", rate("data_quality_score")),
        ("executive_summary", "reconciliation_status", "balanced"),
        ("data_quality", "duplicate_rows", number("duplicate_rows")),
        ("data_quality", "blank_cells", number("null_cells")),
        ("data_quality", "exceptions", number("exception_count")),
        ("data_quality", "quarantined_records", number("quarantined_record_count")),
        ("data_quality", "critical_errors", number("critical_errors")),
        ("data_quality", "controls_passed", number("controls_pass")),
        ("data_quality", "controls_warning", number("controls_warning")),
        ("data_quality", "controls_failed", number("controls_fail")),
        ("operations", "fulfilled_order_value", money("fulfilled_order_value")),
        ("operations", "average_order_value", money("average_order_value")),
        ("operations", "cancellation_rate", rate("cancellation_rate")),
        ("operations", "ticket_volume", number("ticket_volume")),
        ("operations", "ticket_resolution_rate", rate("ticket_resolution_rate")),
        ("operations", "average_resolution_hours", rate("average_resolution_hours")),
        ("operations", "ticket_sla_rate", rate("ticket_sla_rate")),
        ("customers", "ordering_customers", number("ordering_customer_count")),
        ("customers", "top_segment", "segment_name"),
        ("customers", "top_segment_value", money("segment_value")),
        ("customers", "top_segment_orders", number("segment_orders")),
        ("products", "top_category", "category_name"),
        ("products", "top_category_revenue", money("category_value")),
        ("products", "top_category_orders", number("category_orders")),
        ("products", "top_category_units", number("category_units")),
        ("trends", "highest_revenue_month", "best_month_name"),
        ("trends", "highest_revenue", money("best_month_value")),
        ("trends", "lowest_sla_month", "worst_month_name"),
        ("trends", "lowest_sla_rate", rate("worst_month_rate")),
        ("exceptions", "reconciliation_controls", number("reconciliations")),
    )
    return unfold(
        row,
        [{"section": quoted(section), "fact": quoted(fact), "value": text} for section, fact, text in facts],
    )
