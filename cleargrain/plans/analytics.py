"""KPI, trend, ranking and variance queries over a warehouse.

Rates and averages come from exact integer sums, so results do not depend on
how the rows were partitioned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cleargrain.functions import fixed
from cleargrain.functions.measure import (
    cancelled, count_if, dollars, fulfilled, growth, half_up, hours_hundredths, mean_hundredths,
    percent, percent_or_zero, sum_if, within_sla,
)
from cleargrain.operators.records import met_by_key
from cleargrain.operators.validate import expected_amount
from cleargrain.plans.warehouse import Warehouse


def one_row(*frames: DataFrame) -> DataFrame:
    """Merge single-row frames with distinct columns into one row, without a join."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.agg(*[F.max(column).alias(column) for column in merged.columns])


# --- Measures shared by several grains -------------------------------------


def _order_measures() -> list:
    amount = F.col("order_amount_cents")
    return [
        F.count(F.lit(1)).alias("order_count"),
        F.countDistinct("customer_id").alias("customers"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("units"),
        sum_if(fulfilled(), amount).alias("fulfilled_cents"),
        count_if(fulfilled()).alias("fulfilled_orders"),
        count_if(cancelled()).alias("cancelled_orders"),
    ]


def _finance_measures() -> list:
    return [
        sum_if(F.col("posting_status") == "POSTED", F.col("transaction_amount_cents")).alias("net_revenue_cents"),
        count_if(F.col("posting_status") == "PENDING").alias("pending_transactions"),
    ]


def _support_measures() -> list:
    timed = F.col("resolution_hours").isNotNull()
    return [
        F.count(F.lit(1)).alias("ticket_volume"),
        count_if(F.col("ticket_status").isin(*fixed.SETTLED)).alias("resolved_count"),
        F.coalesce(F.sum(hours_hundredths()), F.lit(0)).alias("hours_hundredths"),
        count_if(timed & within_sla()).alias("within_sla"),
        count_if(timed).alias("eligible_sla"),
    ]


def _average_cents() -> Column:
    return F.col("fulfilled_cents") / F.nullif(F.col("fulfilled_orders"), F.lit(0))


def _average_value() -> Column:
    return mean_hundredths(F.col("fulfilled_cents"), F.col("fulfilled_orders"))


# --- Overall KPIs ------------------------------------------------------------


def kpi_orders(wh: Warehouse) -> DataFrame:
    return wh["fact_order"].agg(*_order_measures()).select(
        "order_count",
        F.col("customers").alias("ordering_customers"),
        F.col("fulfilled_cents").alias("fulfilled_value_cents"),
        _average_cents().alias("average_order_cents"),
        "cancelled_orders",
    )


def kpi_finance(wh: Warehouse) -> DataFrame:
    return wh["fact_finance_transaction"].agg(*_finance_measures())


def kpi_support(wh: Warehouse) -> DataFrame:
    return wh["fact_support_ticket"].agg(*_support_measures()).select(
        F.col("ticket_volume").alias("ticket_count"), "resolved_count",
        mean_hundredths(F.col("hours_hundredths"), F.col("eligible_sla")).alias("average_resolution_hours"),
        "within_sla", "eligible_sla",
    )


def quality_inputs(counts: DataFrame, issue_counts: DataFrame) -> DataFrame:
    """Row of the score's inputs, from per-dataset counts and per-kind findings."""
    totals = counts.agg(
        F.sum("unique_rows").alias("total_records"),
        F.sum("quarantined_rows").alias("quarantined_records"),
    )
    hits = F.col("issue_count")
    found = issue_counts.agg(
        F.coalesce(F.sum(hits), F.lit(0)).alias("exception_count"),
        sum_if(F.col("severity") == "CRITICAL", hits).alias("critical_issues"),
        sum_if(F.col("action").isin(*fixed.REMEDIATION_ACTIONS), hits).alias("remediated_issues"),
    )
    return one_row(totals, found)


def quality_score(inputs: DataFrame) -> DataFrame:
    """Issue-weighted score from 0 to 100, two decimals; 0 without records.

    Weights are whole hundredths of a record, so the score is an exact ratio.
    """
    weight = {name: int(value * 100) for name, value in fixed.SCORE_WEIGHTS.items()}
    defects = (
        F.col("critical_issues") * weight["critical"]
        + F.col("quarantined_records") * weight["quarantined"]
        + F.col("remediated_issues") * weight["remediated"]
    )
    whole = F.col("total_records") * 100
    score = percent(F.greatest(whole - defects, F.lit(0)), whole)
    return inputs.select(
        "total_records", "critical_issues", "quarantined_records", "remediated_issues",
        "exception_count",
        F.when(F.col("total_records") > 0, score).otherwise(0.0).alias("data_quality_score"),
    )


def kpi_overall(wh: Warehouse, score: DataFrame) -> DataFrame:
    """The fourteen headline measures as one row."""
    row = one_row(
        wh["fact_order"].agg(*_order_measures()),
        wh["fact_finance_transaction"].agg(*_finance_measures()),
        wh["fact_support_ticket"].agg(*_support_measures()),
        score.select("exception_count", "quarantined_records", "data_quality_score"),
    )
    return row.select(
        dollars(F.col("net_revenue_cents")).alias("net_revenue"),
        dollars(F.col("fulfilled_cents")).alias("fulfilled_order_value"),
        "order_count",
        _average_value().alias("average_order_value"),
        F.col("customers").alias("ordering_customer_count"),
        "ticket_volume",
        percent_or_zero(F.col("resolved_count"), F.col("ticket_volume")).alias("ticket_resolution_rate"),
        mean_hundredths(F.col("hours_hundredths"), F.col("eligible_sla")).alias("average_resolution_hours"),
        percent_or_zero(F.col("within_sla"), F.col("eligible_sla")).alias("ticket_sla_rate"),
        percent_or_zero(F.col("cancelled_orders"), F.col("order_count")).alias("cancellation_rate"),
        F.col("pending_transactions").alias("pending_finance_transactions"),
        "exception_count",
        F.col("quarantined_records").alias("quarantined_record_count"),
        "data_quality_score",
    )


def executive_kpis(wh: Warehouse) -> DataFrame:
    """Nine executive measures; averages are not rounded, rates are."""
    row = one_row(
        wh["fact_order"].agg(*_order_measures()),
        wh["fact_finance_transaction"].agg(*_finance_measures()),
        wh["fact_support_ticket"].agg(*_support_measures()),
    )
    return row.select(
        "order_count", F.col("customers").alias("ordering_customers"),
        dollars(F.col("fulfilled_cents")).alias("fulfilled_order_value"),
        (_average_cents() / F.lit(100.0)).alias("average_order_value"),
        percent(F.col("cancelled_orders"), F.col("order_count")).alias("cancellation_rate"),
        dollars(F.col("net_revenue_cents")).alias("net_revenue"),
        "ticket_volume",
        percent(F.col("resolved_count"), F.col("ticket_volume")).alias("ticket_resolution_rate"),
        (half_up(F.col("hours_hundredths"), F.col("eligible_sla")) / F.lit(100.0)).alias("average_resolution_hours"),
    )


# --- Months --------------------------------------------------------------------


def monthly_orders(wh: Warehouse) -> DataFrame:
    return wh["fact_order"].groupBy("order_month").agg(*_order_measures())


def monthly_finance(wh: Warehouse) -> DataFrame:
    """Ledger activity by posting month (which may differ from the order month)."""
    return wh["fact_finance_transaction"].groupBy("posted_month").agg(*_finance_measures())


def monthly_support(wh: Warehouse) -> DataFrame:
    return wh["fact_support_ticket"].groupBy("opened_month").agg(*_support_measures())


def monthly_trends(wh: Warehouse) -> DataFrame:
    """Order months with ledger and support activity, growth and revenue z-score.

    Windows without a partition run over one row per calendar month.
    """
    finance = monthly_finance(wh).withColumnRenamed("posted_month", "order_month")
    support = monthly_support(wh).withColumnRenamed("opened_month", "order_month")
    months = (
        monthly_orders(wh).join(finance, "order_month", "left").join(support, "order_month", "left")
        .withColumn("net_cents", F.coalesce(F.col("net_revenue_cents"), F.lit(0)))
    )
    prior = F.lag("net_cents").over(Window.orderBy("order_month"))
    everything = Window.partitionBy()
    revenue = dollars(F.col("net_cents"))
    spread = F.stddev_pop(revenue).over(everything)
    z = (revenue - F.avg(revenue).over(everything)) / F.when(spread == 0, 1.0).otherwise(spread)
    return months.withColumn("z", z).select(
        F.col("order_month").alias("reporting_month"),
        "order_count", F.col("customers").alias("unique_customers"),
        F.col("units").alias("units_sold"),
        dollars(F.col("fulfilled_cents")).alias("fulfilled_order_value"),
        revenue.alias("net_revenue"),
        growth(F.col("net_cents"), prior).alias("revenue_mom_growth_pct"),
        _average_value().alias("average_order_value"),
        percent(F.col("cancelled_orders"), F.col("order_count")).alias("cancellation_rate"),
        F.coalesce(F.col("ticket_volume"), F.lit(0)).alias("ticket_volume"),
        percent_or_zero(F.col("resolved_count"), F.col("ticket_volume")).alias("ticket_resolution_rate"),
        percent_or_zero(F.col("within_sla"), F.col("eligible_sla")).alias("ticket_sla_rate"),
        mean_hundredths(F.col("hours_hundredths"), F.col("eligible_sla")).alias("average_resolution_hours"),
        F.round("z", 2).alias("revenue_zscore"),
        F.when(F.abs("z") >= fixed.ANOMALY_Z, "Y").otherwise("N").alias("revenue_anomaly_flag"),
    ).orderBy("reporting_month")


def mom_growth(wh: Warehouse) -> DataFrame:
    months = monthly_orders(wh).join(
        monthly_finance(wh).withColumnRenamed("posted_month", "order_month"), "order_month", "left"
    ).withColumn("net_cents", F.coalesce(F.col("net_revenue_cents"), F.lit(0)))
    calendar = Window.orderBy("order_month")
    return months.select(
        F.col("order_month").alias("reporting_month"), "order_count",
        dollars(F.col("fulfilled_cents")).alias("fulfilled_value"),
        dollars(F.col("net_cents")).alias("net_revenue"),
        growth(F.col("order_count"), F.lag("order_count").over(calendar)).alias("order_growth_pct"),
        growth(F.col("net_cents"), F.lag("net_cents").over(calendar)).alias("revenue_growth_pct"),
    ).orderBy("reporting_month")


# --- Categories, segments, dashboard ------------------------------------------------


def _orders_with_ledger(wh: Warehouse, grain_safe: bool) -> DataFrame:
    """Enriched orders with their posted ledger cents and a row weight.

    The published definition joins orders to ledger rows, so an order with
    several ledger rows is counted once for each. Summing the ledger per order
    first keeps the join one-to-one; ``weight`` then carries the repetition
    (always 1 when grain-safe).
    """
    weight = F.lit(1) if grain_safe else F.coalesce(F.col("ledger_rows"), F.lit(1))
    return wh.orders_with_ledger.withColumn("weight", weight)


def _weighted_measures() -> list:
    weight = F.col("weight")
    return [
        F.sum(weight).cast("bigint").alias("order_count"),
        F.countDistinct("customer_id").alias("customers"),
        F.sum(F.col("quantity") * weight).alias("units"),
        sum_if(fulfilled(), F.col("order_amount_cents") * weight).alias("fulfilled_cents"),
        sum_if(fulfilled(), weight).alias("fulfilled_orders"),
        sum_if(cancelled(), weight).alias("cancelled_orders"),
        F.sum(F.coalesce(F.col("net_cents"), F.lit(0))).alias("net_cents"),
    ]


def category_performance(wh: Warehouse, grain_safe: bool = False) -> DataFrame:
    return _orders_with_ledger(wh, grain_safe).groupBy("product_category").agg(*_weighted_measures()).select(
        "product_category", "order_count", "customers", F.col("units").alias("units_sold"),
        dollars(F.col("fulfilled_cents")).alias("fulfilled_order_value"),
        dollars(F.col("net_cents")).alias("net_revenue"),
    ).orderBy(F.desc("net_revenue"), "product_category")


def dashboard_dataset(wh: Warehouse, grain_safe: bool = False) -> DataFrame:
    """Month by category; revenue belongs to the order's month here."""
    return (
        _orders_with_ledger(wh, grain_safe)
        .groupBy("order_month", "product_category")
        .agg(*_weighted_measures())
        .select(
            F.col("order_month").alias("reporting_month"), "product_category", "order_count",
            F.col("customers").alias("unique_customers"), F.col("units").alias("units_sold"),
            dollars(F.col("fulfilled_cents")).alias("fulfilled_order_value"),
            dollars(F.col("net_cents")).alias("net_revenue"),
            _average_value().alias("average_order_value"),
            percent(F.col("cancelled_orders"), F.col("order_count")).alias("cancellation_rate"),
        )
        .orderBy("reporting_month", "product_category")
    )


def segment_metrics(wh: Warehouse) -> DataFrame:
    """Every customer segment, with or without orders and tickets."""
    segments = wh["dim_customer"].select("customer_segment").distinct()
    orders = wh.enriched_orders.groupBy("customer_segment").agg(*_order_measures())
    tickets = wh.enriched_tickets.groupBy("customer_segment").agg(
        F.countDistinct("customer_id").alias("customers_with_tickets")
    )

    def known(name: str):
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    return (
        segments.join(orders, "customer_segment", "left")
        .join(tickets, "customer_segment", "left")
        .select(
            "customer_segment", known("order_count"), known("customers"),
            dollars(F.col("fulfilled_cents")).alias("fulfilled_order_value"),
            _average_value().alias("average_order_value"),
            known("customers_with_tickets"),
        )
        .orderBy(F.desc("fulfilled_order_value"), "customer_segment")
    )


def segment_having(wh: Warehouse) -> DataFrame:
    return (
        wh.enriched_orders.groupBy("customer_segment").agg(*_order_measures())
        .where(F.col("order_count") >= fixed.SEGMENT_MIN_ORDERS)
        .select(
            "customer_segment", "order_count", F.col("customers").alias("ordering_customers"),
            dollars(F.col("fulfilled_cents")).alias("fulfilled_value"),
        )
        .orderBy(F.desc("fulfilled_value"), "customer_segment")
    )


def category_rank_share(wh: Warehouse) -> DataFrame:
    """Categories by fulfilled value and their share; windows span one row per category."""
    value = F.col("fulfilled_cents")
    return (
        wh.enriched_orders.groupBy("product_category").agg(*_order_measures())
        .select(
            "product_category", "order_count", "units", dollars(value).alias("fulfilled_value"),
            F.dense_rank().over(Window.orderBy(value.desc())).cast("bigint").alias("revenue_rank"),
            percent(value, F.sum(value).over(Window.partitionBy())).alias("revenue_share_pct"),
        )
        .orderBy("revenue_rank", "product_category")
    )


def sla_by_priority(wh: Warehouse) -> DataFrame:
    return (
        wh["fact_support_ticket"].groupBy("priority").agg(*_support_measures())
        .select(
            "priority", "ticket_volume", F.col("resolved_count").alias("resolved_tickets"),
            (half_up(F.col("hours_hundredths"), F.col("eligible_sla")) / F.lit(100.0)).alias("average_resolution_hours"),
            percent(F.col("within_sla"), F.col("eligible_sla")).alias("sla_rate"),
        )
        .orderBy(_urgency(), "priority")
    )


def _urgency() -> Column:
    """Place of a priority, the most urgent first, unknown ones last."""
    names = list(fixed.SLA_HOURS)
    return F.expr("CASE priority " + " ".join(f"WHEN '{name}' THEN {n}" for n, name in enumerate(names)) + f" ELSE {len(names)} END")


def enriched_order_summary(wh: Warehouse) -> DataFrame:
    return (
        wh.enriched_orders.groupBy("order_month", "product_category", "customer_segment")
        .agg(*_order_measures())
        .select(
            "order_month", "product_category", "customer_segment", "order_count", "customers",
            "units", dollars(F.col("fulfilled_cents")).alias("fulfilled_value"),
        )
        .orderBy("order_month", "product_category", "customer_segment")
    )


def top_customers(wh: Warehouse) -> DataFrame:
    """Best customers per segment by fulfilled value.

    Orders are summed per customer before the name is attached, and the row
    limit applies in every task before a segment's rows meet. Rank is taken
    among the kept rows: whoever outranks a kept customer is kept as well.
    """
    value = wh.enriched_orders.groupBy("customer_segment", "customer_id").agg(
        sum_if(fulfilled(), F.col("order_amount_cents")).alias("value_cents")
    )
    by_segment = Window.partitionBy("customer_segment")
    best = value.withColumn(
        "row_number", F.row_number().over(by_segment.orderBy(F.desc("value_cents"), "customer_id"))
    ).where(F.col("row_number") <= fixed.TOP_CUSTOMERS)
    ranked = best.withColumn("value_rank", F.rank().over(by_segment.orderBy(F.desc("value_cents"))))
    names = wh["dim_customer"].select("customer_id", "customer_name")
    return met_by_key(names, names).join(ranked, "customer_id").select(
        "customer_segment", "customer_id", "customer_name",
        dollars(F.col("value_cents")).alias("fulfilled_value"),
        F.col("value_rank").cast("bigint"), F.col("row_number").cast("bigint"),
    ).orderBy("customer_segment", "row_number")


def finance_variance(wh: Warehouse) -> DataFrame:
    """First ledger row of each order against what its status calls for.

    ``min_by`` keeps one row per order before the shuffle, so an order with
    very many ledger rows costs no more than any other.
    """
    first = wh["fact_finance_transaction"].groupBy("order_id").agg(
        F.min_by(
            F.struct("finance_transaction_id", "transaction_amount_cents"),
            F.struct("posted_date", "finance_transaction_id"),
        ).alias("first")
    )
    expected = wh["fact_order"].select(
        "order_id", expected_amount(F.col("order_status"), F.col("order_amount_cents")).alias("expected_cents")
    )
    return (
        first.join(met_by_key(expected, expected), "order_id")
        .select(
            "first.finance_transaction_id", "order_id", "expected_cents", "first.transaction_amount_cents",
            (F.col("first.transaction_amount_cents") - F.col("expected_cents")).alias("variance_cents"),
        )
        .where("variance_cents <> 0")
        .orderBy(F.abs("variance_cents").desc(), "order_id")
    )


def highlights(wh: Warehouse) -> DataFrame:
    """Best category, segment and month, and the month with the lowest SLA.

    Ties go to the first in listing order: categories and segments by their
    listed measure then name, months by calendar.
    """
    return pick_highlights(category_performance(wh), segment_metrics(wh), monthly_trends(wh))


def pick_highlights(categories: DataFrame, segments: DataFrame, months: DataFrame) -> DataFrame:
    def best(frame: DataFrame, label: str, name: str, value: str, lowest: bool = False) -> DataFrame:
        order = F.col(value).asc() if lowest else F.col(value).desc()
        return frame.orderBy(order, F.col(name).asc()).limit(1).select(
            F.lit(label).alias("highlight"), F.col(name).alias("name"),
            F.col(value).cast("double").alias("value"),
        )

    return reduce(
        DataFrame.unionAll,
        [
            best(categories, "top_category", "product_category", "net_revenue"),
            best(segments, "top_segment", "customer_segment", "fulfilled_order_value"),
            best(months, "highest_revenue_month", "reporting_month", "net_revenue"),
            best(months, "lowest_sla_month", "reporting_month", "ticket_sla_rate", lowest=True),
        ],
    )


# --- Findings -----------------------------------------------------------------------


def exception_summary(issue_counts: DataFrame) -> DataFrame:
    return issue_counts.select(
        "dataset", "issue_type", "severity", "action", F.col("issue_count").alias("exception_count")
    ).orderBy(F.desc("exception_count"), "dataset", "issue_type", "severity", "action")


def exception_rank(issue_counts: DataFrame) -> DataFrame:
    """Kinds of finding ranked within their dataset; one row per kind reaches the window."""
    counted = issue_counts.groupBy("dataset", "issue_type").agg(F.sum("issue_count").alias("exception_count"))
    by_count = Window.partitionBy("dataset").orderBy(F.desc("exception_count"))
    ranked = counted.withColumn("issue_rank", F.dense_rank().over(by_count).cast("bigint"))
    return ranked.orderBy("dataset", "issue_rank", "issue_type")


def range_audit(wh: Warehouse) -> DataFrame:
    return wh["fact_order"].agg(
        count_if(F.col("quantity") <= 0).alias("invalid_quantity"),
        count_if(F.col("order_amount_cents") < 0).alias("negative_order_amount"),
        count_if(~F.col("discount_basis_points").between(0, 10000)).alias("invalid_discount"),
    )
