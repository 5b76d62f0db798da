"""Governed vocabulary: every value here is fixed by the data contract."""

# --- Fixed values: datasets, keys and raw column order --------------------

RAW_COLUMNS = {
    "customers": (
        "customer_id", "customer_name", "customer_segment", "region",
        "created_date", "crm_status",
    ),
    "products": (
        "product_id", "product_name", "product_category", "unit_price",
        "unit_cost", "active_flag",
    ),
    "orders": (
        "order_id", "customer_id", "product_id", "order_date", "quantity",
        "unit_price", "discount_rate", "order_amount", "order_status", "channel",
    ),
    "support_tickets": (
        "ticket_id", "customer_id", "opened_at", "resolved_at", "ticket_status",
        "priority", "issue_category", "satisfaction_score",
    ),
    "finance_transactions": (
        "finance_transaction_id", "order_id", "posted_date", "transaction_type",
        "transaction_amount", "currency", "posting_status",
    ),
}
DATASETS = tuple(RAW_COLUMNS)
KEYS = {name: columns[0] for name, columns in RAW_COLUMNS.items()}
AMOUNTS = {"orders": "order_amount", "finance_transactions": "transaction_amount"}

# --- Fixed values: domains -------------------------------------------------

SEGMENTS = ("SMB", "MID_MARKET", "ENTERPRISE")
CATEGORIES = ("SOFTWARE", "HARDWARE", "SERVICES", "SECURITY", "CLOUD", "DATA")
ORDER_STATUSES = ("COMPLETED", "SHIPPED", "CANCELLED", "RETURNED")
PRIORITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
FINANCE_TYPES = ("SALE", "REFUND", "ADJUSTMENT")
TICKET_STATUSES = ("OPEN", "RESOLVED", "CLOSED")
CRM_STATUSES = ("ACTIVE", "INACTIVE")
ACTIVE_FLAGS = ("Y", "N")
CHANNELS = ("DIRECT", "PARTNER", "ONLINE")
CURRENCIES = ("USD",)
POSTING_STATUSES = ("POSTED", "PENDING")
FULFILLED = ("COMPLETED", "SHIPPED")
SETTLED = ("RESOLVED", "CLOSED")
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
ACTIONS = (
    "DEDUPLICATE", "STANDARDIZE", "DEFAULT_UNKNOWN", "REVIEW", "QUARANTINE",
    "FAIL_PIPELINE",
)

# --- Fixed values: aliases (token -> governed value; governed values map to
#     themselves and need no entry) -----------------------------------------

SEGMENT_ALIASES = {"SMALL_BUSINESS": "SMB"}
CATEGORY_ALIASES = {
    "PROFESSIONAL_SERVICES": "SERVICES", "CYBERSECURITY": "SECURITY",
    "CLOUD_SERVICES": "CLOUD", "DATA_ANALYTICS": "DATA",
}
ORDER_STATUS_ALIASES = {
    "COMPLETE": "COMPLETED", "CANCELED": "CANCELLED", "RETURN": "RETURNED",
}
PRIORITY_ALIASES = {"MED": "MEDIUM", "HIGH_PRIORITY": "HIGH", "URGENT": "CRITICAL"}
FINANCE_TYPE_ALIASES = {"CREDIT": "REFUND"}

# --- Fixed values: thresholds ----------------------------------------------

UNUSUAL_UNIT_PRICE = 20000
UNUSUAL_ORDER_AMOUNT = 100000
SLA_HOURS = {"CRITICAL": 24, "HIGH": 48, "MEDIUM": 72, "LOW": 120}
SEGMENT_MIN_ORDERS = 100
ANOMALY_Z = 2
SCORE_WEIGHTS = {"critical": 5, "quarantined": 1.5, "remediated": 0.25}
REMEDIATION_ACTIONS = ("REVIEW", "STANDARDIZE", "DEFAULT_UNKNOWN", "DEDUPLICATE")
TOP_VALUES = 10
TOP_ISSUES = 6
TOP_CUSTOMERS = 5
CRITICAL_MESSAGES_SHOWN = 30

# --- Fixed values: KPI catalogue (name, unit, definition) ------------------

KPIS = (
    ("net_revenue", "USD", "Posted synthetic finance activity, net of refunds and adjustments"),
    ("fulfilled_order_value", "USD", "Order value for completed and shipped orders"),
    ("order_count", "COUNT", "Validated orders loaded to the warehouse"),
    ("average_order_value", "USD", "Average value of completed and shipped orders"),
    ("ordering_customer_count", "COUNT", "Distinct customers with a validated order"),
    ("ticket_volume", "COUNT", "Validated support tickets"),
    ("ticket_resolution_rate", "PERCENT", "Share of tickets in resolved or closed status"),
    ("average_resolution_hours", "HOURS", "Average elapsed time for resolved tickets"),
    ("ticket_sla_rate", "PERCENT", "Resolved tickets within priority-based SLA thresholds"),
    ("cancellation_rate", "PERCENT", "Cancelled orders as a share of loaded orders"),
    ("pending_finance_transactions", "COUNT", "Finance transactions awaiting posting"),
    ("exception_count", "COUNT", "Detected source-quality exceptions, including remediated records"),
    ("quarantined_record_count", "COUNT", "Unsafe fact records excluded with audit evidence"),
    ("data_quality_score", "PERCENT", "Issue-weighted score across unique source records"),
)

# --- Fixed values: characters that count as white space in source text -----

WHITESPACE = "".join(
    chr(point)
    for point in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)
