"""Fixed schemas of the warehouse tables."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

# Column names and types of the published tables.
_COLUMNS = {
    "dim_customer":
        "customer_id string, customer_name string, customer_segment string, region string,"
        " created_date string, crm_status string, quality_flag string",
    "dim_product":
        "product_id string, product_name string, product_category string, unit_price_cents bigint,"
        " unit_cost_cents bigint, active_flag string, quality_flag string",
    "fact_order":
        "order_id string, customer_id string, product_id string, order_date string,"
        " order_month string, quantity bigint, unit_price_cents bigint, discount_basis_points bigint,"
        " order_amount_cents bigint, order_status string, channel string, quality_flag string",
    "fact_support_ticket":
        "ticket_id string, customer_id string, opened_at string, opened_month string,"
        " resolved_at string, ticket_status string, priority string, issue_category string,"
        " resolution_hours double, satisfaction_score int, quality_flag string",
    "fact_finance_transaction":
        "finance_transaction_id string, order_id string, posted_date string, posted_month string,"
        " transaction_type string, transaction_amount_cents bigint, currency string,"
        " posting_status string, quality_flag string",
    "order_quarantine":
        "order_id string, customer_id string, product_id string, order_date string,"
        " order_amount_cents bigint, quarantine_reason string",
    "support_ticket_quarantine":
        "ticket_id string, customer_id string, opened_at string, quarantine_reason string",
    "finance_transaction_quarantine":
        "finance_transaction_id string, order_id string, posted_date string,"
        " transaction_amount_cents bigint, quarantine_reason string",
    "data_quality_exception":
        "exception_id string, dataset string, record_id string, issue_type string,"
        " severity string, action string, message string",
    "etl_control":
        "control_name string, dataset string, unit string, source_value bigint,"
        " target_value bigint, difference bigint, status string",
}
_TYPES = {"string": StringType(), "bigint": LongType(), "int": IntegerType(), "double": DoubleType()}


def _schema(columns: str) -> StructType:
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


WAREHOUSE = {name: _schema(columns) for name, columns in _COLUMNS.items()}
