"""The declarative rule catalogue.

A record's findings travel as one ``issue_mask`` integer: bit ``n`` says that
rule ``n`` of its dataset hit. The mask is cheap to shuffle and store, filters
push down on it, and the texts are attached only where findings are listed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleargrain.functions import fixed
from cleargrain.functions.unfold import quoted

MASK = "issue_mask"


@dataclass(frozen=True)
class Rule:
    dataset: str
    name: str
    issue_type: str
    severity: str
    action: str
    message: str
    bit: int

    @property
    def flag(self) -> int:
        return 1 << self.bit


_CRITICAL = ("CRITICAL", "FAIL_PIPELINE")
_QUARANTINE = ("HIGH", "QUARANTINE")
_REVIEW = ("MEDIUM", "REVIEW")
_STANDARDIZE = ("LOW", "STANDARDIZE")

# --- Fixed values: rules per dataset in the order findings are emitted -----
# (name, issue type, (severity, action), message)

_KEY_RULES = (
    ("repeated_key", "DUPLICATE_BUSINESS_KEY", ("MEDIUM", "DEDUPLICATE"), "Duplicate {key}; keep first deterministic row"),
    ("missing_key", "MISSING_PRIMARY_KEY", _CRITICAL, "{key} is required"),
)
_ROW_RULES = {
    "customers": (
        ("no_customer_name", "MISSING_REQUIRED_FIELD", _CRITICAL, "customer_name is required"),
        ("no_customer_segment", "MISSING_REQUIRED_FIELD", _CRITICAL, "customer_segment is required"),
        ("no_created_date", "MISSING_REQUIRED_FIELD", _CRITICAL, "created_date is required"),
        ("no_crm_status", "MISSING_REQUIRED_FIELD", _CRITICAL, "crm_status is required"),
        ("bad_created_date", "MALFORMED_DATE", _CRITICAL, "created_date must be ISO format"),
        ("unknown_segment", "INVALID_CATEGORY", _CRITICAL, "customer segment is outside the governed domain"),
        ("alias_segment", "CATEGORY_STANDARDIZED", _STANDARDIZE, "Customer segment mapped to canonical value"),
        ("no_region", "MISSING_REGION", ("MEDIUM", "DEFAULT_UNKNOWN"), "Missing region standardized to UNKNOWN"),
    ),
    "products": (
        ("no_product_name", "MISSING_REQUIRED_FIELD", _CRITICAL, "product_name is required"),
        ("no_product_category", "MISSING_REQUIRED_FIELD", _CRITICAL, "product_category is required"),
        ("no_unit_price", "MISSING_REQUIRED_FIELD", _CRITICAL, "unit_price is required"),
        ("no_unit_cost", "MISSING_REQUIRED_FIELD", _CRITICAL, "unit_cost is required"),
        ("no_active_flag", "MISSING_REQUIRED_FIELD", _CRITICAL, "active_flag is required"),
        ("unknown_category", "INVALID_CATEGORY", _CRITICAL, "product category is outside the governed domain"),
        ("alias_category", "CATEGORY_STANDARDIZED", _STANDARDIZE, "Product category mapped to canonical value"),
        ("bad_price", "INVALID_PRODUCT_AMOUNT", _CRITICAL, "Product price/cost hierarchy is invalid"),
        ("unusual_price", "UNUSUAL_NUMERIC_VALUE", _REVIEW, "Unit price exceeds the profiling threshold"),
    ),
    "orders": (
        ("no_customer", "MISSING_REQUIRED_FIELD", _QUARANTINE, "customer_id is required"),
        ("unknown_customer", "INVALID_CUSTOMER_REFERENCE", _QUARANTINE, "Customer does not exist in CRM source"),
        ("unknown_product", "INVALID_PRODUCT_REFERENCE", _QUARANTINE, "Product does not exist in product master"),
        ("bad_order_date", "MALFORMED_DATE", _QUARANTINE, "order_date must be ISO format"),
        ("bad_quantity", "INVALID_QUANTITY", _QUARANTINE, "quantity must be a positive integer"),
        ("bad_amount", "INVALID_ORDER_AMOUNT", _QUARANTINE, "order amount must be nonnegative"),
        ("bad_price_or_discount", "INVALID_NUMERIC_VALUE", _QUARANTINE, "price or discount is outside the valid range"),
        ("unusual_amount", "UNUSUAL_NUMERIC_VALUE", _REVIEW, "Order amount exceeds the high-value review threshold"),
        ("unknown_status", "INVALID_CATEGORY", _QUARANTINE, "Order status is outside the governed domain"),
        ("alias_status", "CATEGORY_STANDARDIZED", _STANDARDIZE, "Order status mapped to canonical value"),
    ),
    "support_tickets": (
        ("unknown_customer", "INVALID_CUSTOMER_REFERENCE", _QUARANTINE, "Ticket customer does not exist"),
        ("bad_timestamps", "MALFORMED_DATE", _QUARANTINE, "Ticket timestamps must be ISO format"),
        ("resolved_early", "INVALID_DATE_SEQUENCE", _QUARANTINE, "Resolution precedes ticket creation"),
        ("no_issue_category", "MISSING_REQUIRED_FIELD", _QUARANTINE, "issue_category is required"),
        ("unknown_priority", "INVALID_CATEGORY", _QUARANTINE, "Priority is outside the governed domain"),
        ("alias_priority", "CATEGORY_STANDARDIZED", _STANDARDIZE, "Priority mapped to canonical value"),
    ),
    "finance_transactions": (
        ("unknown_order", "INVALID_ORDER_REFERENCE", _QUARANTINE, "Finance order does not exist in order source"),
        ("bad_posted_date", "MALFORMED_DATE", _QUARANTINE, "posted_date must be ISO format"),
        ("bad_amount", "INVALID_NUMERIC_VALUE", _QUARANTINE, "Transaction amount must be numeric"),
        ("unknown_type", "INVALID_CATEGORY", _QUARANTINE, "Transaction type is outside the governed domain"),
        ("alias_type", "CATEGORY_STANDARDIZED", _STANDARDIZE, "Finance type mapped to canonical value"),
        ("bad_currency_or_posting", "INVALID_CATEGORY", _QUARANTINE, "Currency or posting status is invalid"),
        ("ledger_mismatch", "FINANCE_ORDER_AMOUNT_MISMATCH", _REVIEW, "Ledger amount differs from the status-based order expectation"),
        ("order_not_loaded", "ORDER_NOT_LOADED", _QUARANTINE, "Referenced order was quarantined and is unavailable to the warehouse fact"),
    ),
}
KEY_RULES = ("repeated_key", "missing_key")
CASCADE_RULE = "order_not_loaded"
MISSING_KEY_ID = "MISSING_KEY"


def _catalogue(dataset: str) -> tuple[Rule, ...]:
    key = fixed.KEYS[dataset]
    return tuple(
        Rule(dataset, name, issue_type, severity, action, message.replace("{key}", key), bit)
        for bit, (name, issue_type, (severity, action), message) in enumerate(
            (*_KEY_RULES, *_ROW_RULES[dataset])
        )
    )


CATALOGUE = {dataset: _catalogue(dataset) for dataset in fixed.DATASETS}


def with_mask(dataset: str, rows: DataFrame, hits: dict[str, Column], name: str = MASK) -> DataFrame:
    """Add one integer holding every rule that hits; an unknown outcome is no hit."""
    total = " + ".join(
        f"CASE WHEN hit_{rule.name} THEN {rule.flag}L ELSE 0L END"
        for rule in CATALOGUE[dataset]
        if rule.name in hits
    )
    marked = rows.select("*", *[hit.alias(f"hit_{rule}") for rule, hit in hits.items()])
    return marked.withColumn(name, F.expr(total)).drop(*[f"hit_{rule}" for rule in hits])


def flags_with(dataset: str, **wanted: str) -> int:
    """Combined bits of the rules whose fields equal the wanted values."""
    return sum(
        rule.flag
        for rule in CATALOGUE[dataset]
        if all(getattr(rule, field) == value for field, value in wanted.items())
    )


def hit_sql(flags: int, mask: str = MASK) -> str:
    return f"({mask} & {flags}L) <> 0"


def has_any(flags: int, mask: str = MASK) -> Column:
    return F.expr(hit_sql(flags, mask))


def quarantined(dataset: str) -> Column:
    return has_any(flags_with(dataset, action="QUARANTINE"))


def _of_record(dataset: str) -> list[Rule]:
    """Rules that name the record: a missing key is listed under an id of its own."""
    return [rule for rule in CATALOGUE[dataset] if rule.name != "missing_key"]


def reason(dataset: str) -> Column:
    """Sorted distinct issue types of the record, joined by ``|``."""
    types = sorted({rule.issue_type for rule in _of_record(dataset)})
    parts = (
        f"CASE WHEN {hit_sql(flags_with(dataset, issue_type=name))} THEN '{name}' END" for name in types
    )
    return F.expr(f"concat_ws('|', {', '.join(parts)})")


def quality_flag(dataset: str) -> Column:
    """Sorted issue types of the record, one per finding, or ``PASS``."""
    ranked = sorted(_of_record(dataset), key=lambda rule: (rule.issue_type, rule.bit))
    parts = (f"CASE WHEN {hit_sql(rule.flag)} THEN '{rule.issue_type}' END" for rule in ranked)
    own = sum(rule.flag for rule in ranked)
    return F.expr(f"CASE WHEN {MASK} & {own}L = 0 THEN 'PASS' ELSE concat_ws('|', {', '.join(parts)}) END")


def list_issues(dataset: str, validated: DataFrame) -> DataFrame:
    """One row per finding, with the columns that decide its emission order.

    Repeated and missing keys of all datasets come first, dataset by dataset;
    then row findings by dataset, row and rule; cascaded quarantines last.
    """
    entries = []
    for rule in CATALOGUE[dataset]:
        phase = 0 if rule.name in KEY_RULES else 2 if rule.name == CASCADE_RULE else 1
        fields = {
            "flag": f"{rule.flag}L", "phase": phase, "rule_no": rule.bit,
            "keyless": rule.name == "missing_key", "by_key": rule.name == "repeated_key",
            "issue_type": quoted(rule.issue_type), "severity": quoted(rule.severity),
            "action": quoted(rule.action), "message": quoted(rule.message),
        }
        entries.append("struct(" + ", ".join(f"{value} AS {name}" for name, value in fields.items()) + ")")
    return (
        validated.where(f"{MASK} <> 0")
        .selectExpr(
            f"coalesce({fixed.KEYS[dataset]}, '') AS own_id", MASK, "row_order",
            f"explode(array({', '.join(entries)})) AS rule",
        )
        .where(f"({MASK} & rule.flag) <> 0")
        .selectExpr(
            f"'{dataset}' AS dataset",
            f"CASE WHEN rule.keyless THEN '{MISSING_KEY_ID}' ELSE own_id END AS record_id",
            "rule.issue_type", "rule.severity", "rule.action", "rule.message", "rule.phase",
            f"{fixed.DATASETS.index(dataset)} AS dataset_no",
            "CASE WHEN rule.phase = 0 THEN rule.rule_no ELSE -1 END AS step",
            "CASE WHEN rule.by_key THEN own_id ELSE '' END AS by_key",
            "row_order", "rule.rule_no",
        )
    )


EMISSION_ORDER = ("phase", "step", "by_key", "row_order", "rule_no")
ISSUE_COLUMNS = ("dataset", "record_id", "issue_type", "severity", "action", "message")
