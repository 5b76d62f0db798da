"""Constraint audits of the warehouse tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleargrain.functions import fixed
from cleargrain.functions.unfold import quoted, unfold
from cleargrain.operators.records import count_repeated, find_duplicates, met_by_key

# --- Fixed values: table keys, references and column rules ------------------

PRIMARY_KEYS = {
    "dim_customer": "customer_id",
    "dim_product": "product_id",
    "fact_order": "order_id",
    "fact_support_ticket": "ticket_id",
    "fact_finance_transaction": "finance_transaction_id",
    "order_quarantine": "order_id",
    "support_ticket_quarantine": "ticket_id",
    "finance_transaction_quarantine": "finance_transaction_id",
    "data_quality_exception": "exception_id",
    "etl_control": "control_name",
}
REFERENCES = (
    ("ORDER_CUSTOMER_FK", "fact_order", "customer_id", "dim_customer"),
    ("ORDER_PRODUCT_FK", "fact_order", "product_id", "dim_product"),
    ("TICKET_CUSTOMER_FK", "fact_support_ticket", "customer_id", "dim_customer"),
    ("FINANCE_ORDER_FK", "fact_finance_transaction", "order_id", "fact_order"),
)
NULLABLE = {
    "fact_support_ticket": ("resolved_at", "resolution_hours", "satisfaction_score"),
    "order_quarantine": ("customer_id", "product_id", "order_date", "order_amount_cents"),
    "support_ticket_quarantine": ("customer_id", "opened_at"),
    "finance_transaction_quarantine": ("order_id", "posted_date", "transaction_amount_cents"),
}
DOMAINS = {
    "dim_customer": {"customer_segment": fixed.SEGMENTS, "crm_status": fixed.CRM_STATUSES},
    "dim_product": {"product_category": fixed.CATEGORIES, "active_flag": fixed.ACTIVE_FLAGS},
    "fact_order": {"order_status": fixed.ORDER_STATUSES, "channel": fixed.CHANNELS},
    "fact_support_ticket": {"ticket_status": fixed.TICKET_STATUSES, "priority": fixed.PRIORITIES},
    "fact_finance_transaction": {
        "transaction_type": fixed.FINANCE_TYPES, "currency": fixed.CURRENCIES,
        "posting_status": fixed.POSTING_STATUSES,
    },
    "data_quality_exception": {"severity": fixed.SEVERITIES, "action": fixed.ACTIONS},
    "etl_control": {"unit": ("COUNT", "CENTS"), "status": ("PASS", "FAIL")},
}
RANGES = {
    "dim_product": {
        "unit_price_cents": "unit_price_cents > 0",
        "unit_cost_cents": "unit_cost_cents BETWEEN 0 AND unit_price_cents",
    },
    "fact_order": {
        "quantity": "quantity > 0",
        "unit_price_cents": "unit_price_cents > 0",
        "discount_basis_points": "discount_basis_points BETWEEN 0 AND 10000",
        "order_amount_cents": "order_amount_cents >= 0",
    },
    "fact_support_ticket": {
        "resolution_hours": "resolution_hours >= 0",
        "satisfaction_score": "satisfaction_score BETWEEN 1 AND 5",
    },
}


def constraint_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations of NOT NULL, domain and range rules; one scan per table.

    A domain or range rule judges present values only, as a CHECK does.
    """
    return reduce(DataFrame.unionAll, [_audit_table(name, frame) for name, frame in tables.items()])


def _audit_table(name: str, frame: DataFrame) -> DataFrame:
    checks: list[tuple[str, str, str]] = []
    for column in frame.columns:
        if column not in NULLABLE.get(name, ()):
            checks.append((column, "NOT_NULL", f"{column} IS NULL"))
    for column, domain in DOMAINS.get(name, {}).items():
        allowed = ", ".join(quoted(value) for value in domain)
        checks.append((column, "DOMAIN", f"{column} NOT IN ({allowed})"))
    for column, rule in RANGES.get(name, {}).items():
        checks.append((column, "RANGE", f"NOT ({rule})"))
    counted = frame.selectExpr(
        *[f"count_if({broken}) AS c{n}" for n, (_, _, broken) in enumerate(checks)]
    )
    entries = [
        {
            "table_name": quoted(name), "column_name": quoted(column),
            "check_name": quoted(kind), "violations": f"c{n}",
        }
        for n, (column, kind, _) in enumerate(checks)
    ]
    return unfold(counted, entries)


def key_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Repeated primary keys per table; the few rows of controls are made once only."""
    return reduce(
        DataFrame.unionAll,
        [
            (count_repeated if name == "etl_control" else find_duplicates)(frame, PRIMARY_KEYS[name]).agg(
                F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("repeated_keys")
            )
            for name, frame in tables.items()
        ],
    )


def reference_audit(tables: dict[str, DataFrame], names: tuple[str, ...] | None = None) -> DataFrame:
    """Fact rows whose parent is missing, per foreign key; counted per key before the join."""
    audits = []
    for control, child, column, parent in REFERENCES:
        if names is not None and control not in names:
            continue
        held = tables[child].groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
        known = tables[parent].select(F.col(PRIMARY_KEYS[parent]).alias("value"))
        audits.append(
            held.join(met_by_key(known, known), "value", "left_anti").agg(
                F.lit(control).alias("control_name"), F.coalesce(F.sum("rows"), F.lit(0)).alias("issue_count")
            )
        )
    return reduce(DataFrame.unionAll, audits)
