"""Plain-SQL answers to the registered queries, for checking against another engine.

Only the recipes that derive the raw sources and the rule texts are shared
with the jobs; everything computed from them is worked out again here, rule by
rule and join by join, the way one would write it for a small database.
"""

from __future__ import annotations

import re

from cleargrain.functions import fixed
from cleargrain.operators import audit
from cleargrain.operators.rules import CASCADE_RULE, CATALOGUE, KEY_RULES
from cleargrain.plans.catalog import DAMAGED, DIRTY, RAW_REFERENCES, REQUIRED
from cleargrain.sources import schemas
from cleargrain.sources.adapter import BASE_TABLES, DAMAGE, DIRTY_RECIPES, RECIPES

CTES: dict[str, str] = {}
ANSWERS: dict[str, str] = {}


def _list(values) -> str:
    return "(" + ", ".join(f"'{value}'" for value in values) + ")"


def _token(column: str) -> str:
    return f"replace(trim(regexp_replace(upper({column}), '[-\\s]+', ' ', 'g')), ' ', '_')"


def _governed(column: str, aliases: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{alias}' THEN '{value}'" for alias, value in aliases.items())
    return f"CASE {_token(column)} {cases} ELSE {_token(column)} END"


def _number(column: str) -> str:
    return f"TRY_CAST({column} AS DECIMAL(38,18))"


def _cents(column: str) -> str:
    return f"CAST(round({_number(column)} * 100, 0) AS BIGINT)"


def _is_date(column: str) -> str:
    return (
        f"(regexp_full_match({column}, '\\d{{4}}-\\d{{2}}-\\d{{2}}')"
        f" AND TRY_CAST({column} AS DATE) IS NOT NULL)"
    )


def _time(column: str) -> str:
    plain = f"TRY_CAST(replace({column}, 'T', ' ') AS TIMESTAMP)"
    local = f"TRY_CAST(replace(left({column}, 16), 'T', ' ') || ':00' AS TIMESTAMP)"
    minutes = f"(60 * TRY_CAST({column}[18:19] AS INTEGER) + TRY_CAST({column}[21:22] AS INTEGER))"
    return (
        f"CASE length({column}) WHEN 16 THEN {local} WHEN 19 THEN {plain}"
        f" WHEN 22 THEN {local} - CASE {column}[17] WHEN '-' THEN -1 ELSE 1 END * {minutes} * INTERVAL '1' MINUTE END"
    )


def _half_up(number: str, by: str) -> str:
    """Nearest whole ratio, halves away from zero, in huge integers."""
    size = f"abs(CAST({number} AS HUGEINT))"
    base = f"nullif(CAST({by} AS HUGEINT), 0)"
    return f"(CAST(sign({number}) AS HUGEINT) * ((2 * {size} + {base}) // (2 * {base})))"


def _pct(part: str, whole: str) -> str:
    return f"(CAST({_half_up(f'(10000 * CAST({part} AS HUGEINT))', whole)} AS BIGINT) / 100.0::DOUBLE)"


def _pct0(part: str, whole: str) -> str:
    return f"coalesce({_pct(part, whole)}, 0.0::DOUBLE)"


def _dollars(cents: str) -> str:
    return f"(CAST(coalesce({cents}, 0) AS BIGINT) / 100.0::DOUBLE)"


def _mean(total: str, count: str) -> str:
    return f"(CAST(coalesce({_half_up(total, count)}, 0) AS BIGINT) / 100.0::DOUBLE)"


# --- Raw sources and their first rows ----------------------------------------



def _raw(recipes) -> dict[str, str]:
    """The steps that derive the raw sources."""
    steps = {}
    for dataset, recipe in recipes.items():
        columns = ", ".join(f"{sql} AS {column}" for column, sql in recipe.columns.items())
        steps[f"base_{dataset}"] = recipe.base.replace("$TIMESTAMP", "TIMESTAMP").format(**{t: t for t in BASE_TABLES})
        steps[f"raw_{dataset}"] = (
            f"SELECT 0 AS src_pass, k, {columns} FROM base_{dataset} UNION ALL"
            f" SELECT 1 AS src_pass, k, {columns} FROM base_{dataset} WHERE {recipe.arrives_twice}"
        )
    return steps


CTES.update(_raw(RECIPES))
for _dataset in RECIPES:
    _key = fixed.KEYS[_dataset]
    CTES[f"uniq_{_dataset}"] = (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_key} ORDER BY src_pass, k,"
        f" {', '.join(fixed.RAW_COLUMNS[_dataset])}) AS nth,"
        f" count(*) OVER (PARTITION BY {_key}) AS copies FROM raw_{_dataset}) WHERE nth = 1"
    )

# --- Judged records: governed values and parsed numbers beside the raw text ---

CTES["judged_customers"] = (
    f"SELECT *, {_governed('customer_segment', fixed.SEGMENT_ALIASES)} AS segment FROM uniq_customers"
)
CTES["judged_products"] = (
    f"SELECT *, {_governed('product_category', fixed.CATEGORY_ALIASES)} AS category,"
    f" {_number('unit_price')} AS price, {_number('unit_cost')} AS cost FROM uniq_products"
)
CTES["judged_orders"] = f"""
    SELECT o.*, {_governed('o.order_status', fixed.ORDER_STATUS_ALIASES)} AS status,
           {_number('o.quantity')} AS units, {_number('o.order_amount')} AS amount,
           {_number('o.unit_price')} AS price, {_number('o.discount_rate')} AS discount,
           c.customer_id IS NOT NULL AS has_customer, p.product_id IS NOT NULL AS has_product
    FROM uniq_orders o
    LEFT JOIN uniq_customers c ON c.customer_id = o.customer_id AND o.customer_id <> ''
    LEFT JOIN uniq_products p ON p.product_id = o.product_id AND o.product_id <> ''
"""
CTES["judged_support_tickets"] = f"""
    SELECT t.*, {_governed('t.priority', fixed.PRIORITY_ALIASES)} AS governed_priority,
           {_time('t.opened_at')} AS opened, {_time('t.resolved_at')} AS resolved,
           EXISTS (SELECT 1 FROM uniq_customers c WHERE c.customer_id = t.customer_id) AS has_customer
    FROM uniq_support_tickets t
"""
CTES["judged_finance_transactions"] = f"""
    SELECT f.*, {_governed('f.transaction_type', fixed.FINANCE_TYPE_ALIASES)} AS governed_type,
           {_cents('f.transaction_amount')} AS ledger, o.order_id IS NOT NULL AS has_order,
           CASE WHEN {_cents('o.order_amount')} IS NULL THEN NULL
                WHEN o.status IN {_list(fixed.FULFILLED)} THEN {_cents('o.order_amount')}
                WHEN o.status = 'RETURNED' THEN -abs({_cents('o.order_amount')})
                ELSE 0 END AS expected
    FROM uniq_finance_transactions f
    LEFT JOIN judged_orders o ON o.order_id = f.order_id
"""

# --- When each rule hits -------------------------------------------------------

HITS = {
    "customers": {
        "no_customer_name": "customer_name = ''",
        "no_customer_segment": "customer_segment = ''",
        "no_created_date": "created_date = ''",
        "no_crm_status": "crm_status = ''",
        "bad_created_date": f"created_date <> '' AND NOT {_is_date('created_date')}",
        "unknown_segment": f"segment NOT IN {_list(fixed.SEGMENTS)}",
        "alias_segment": f"segment IN {_list(fixed.SEGMENTS)} AND segment <> customer_segment",
        "no_region": "region = ''",
    },
    "products": {
        "no_product_name": "product_name = ''",
        "no_product_category": "product_category = ''",
        "no_unit_price": "unit_price = ''",
        "no_unit_cost": "unit_cost = ''",
        "no_active_flag": "active_flag = ''",
        "unknown_category": f"category NOT IN {_list(fixed.CATEGORIES)}",
        "alias_category": f"category IN {_list(fixed.CATEGORIES)} AND category <> product_category",
        "bad_price": "price IS NULL OR cost IS NULL OR price <= 0 OR cost < 0 OR cost > price",
        "unusual_price": f"price > {fixed.UNUSUAL_UNIT_PRICE} AND cost BETWEEN 0 AND price",
    },
    "orders": {
        "no_customer": "customer_id = ''",
        "unknown_customer": "customer_id <> '' AND NOT has_customer",
        "unknown_product": "NOT has_product",
        "bad_order_date": f"NOT {_is_date('order_date')}",
        "bad_quantity": "units IS NULL OR units <= 0 OR units <> trunc(units)",
        "bad_amount": "amount IS NULL OR amount < 0",
        "bad_price_or_discount":
            "price IS NULL OR price <= 0 OR discount IS NULL OR discount NOT BETWEEN 0 AND 1",
        "unusual_amount": f"amount > {fixed.UNUSUAL_ORDER_AMOUNT}",
        "unknown_status": f"status NOT IN {_list(fixed.ORDER_STATUSES)}",
        "alias_status": f"status IN {_list(fixed.ORDER_STATUSES)} AND status <> order_status",
    },
    "support_tickets": {
        "unknown_customer": "NOT has_customer",
        "bad_timestamps": "opened IS NULL OR (resolved_at <> '' AND resolved IS NULL)",
        "resolved_early": "resolved < opened",
        "no_issue_category": "issue_category = ''",
        "unknown_priority": f"governed_priority NOT IN {_list(fixed.PRIORITIES)}",
        "alias_priority": f"governed_priority IN {_list(fixed.PRIORITIES)} AND governed_priority <> priority",
    },
    "finance_transactions": {
        "unknown_order": "NOT has_order",
        "bad_posted_date": f"NOT {_is_date('posted_date')}",
        "bad_amount": "ledger IS NULL",
        "unknown_type": f"governed_type NOT IN {_list(fixed.FINANCE_TYPES)}",
        "alias_type": f"governed_type IN {_list(fixed.FINANCE_TYPES)} AND governed_type <> transaction_type",
        "bad_currency_or_posting":
            f"currency <> 'USD' OR posting_status NOT IN {_list(fixed.POSTING_STATUSES)}",
        "ledger_mismatch": "has_order AND ledger <> expected",
    },
}


def _issue_select(dataset: str, rule, phase: int, table: str, condition: str) -> str:
    key = fixed.KEYS[dataset]
    by_key = key if rule.name == "repeated_key" else "''"
    record = "'MISSING_KEY'" if rule.name == "missing_key" else key
    step = rule.bit if phase == 0 else -1
    return (
        f"SELECT {phase} AS phase, {fixed.DATASETS.index(dataset)} AS dataset_no, {step} AS step,"
        f" {by_key} AS by_key, src_pass, k, {rule.bit} AS rule_no, '{dataset}' AS dataset,"
        f" {record} AS record_id, '{rule.issue_type}' AS issue_type, '{rule.severity}' AS severity,"
        f" '{rule.action}' AS action, '{rule.message}' AS message FROM {table} WHERE {condition}"
    )


for _dataset, _rules in CATALOGUE.items():
    _key = fixed.KEYS[_dataset]
    _conditions = {"repeated_key": f"copies > 1 AND {_key} <> ''", "missing_key": f"{_key} = ''", **HITS[_dataset]}
    CTES[f"own_issues_{_dataset}"] = " UNION ALL ".join(
        _issue_select(_dataset, rule, 0 if rule.name in KEY_RULES else 1, f"judged_{_dataset}", _conditions[rule.name])
        for rule in _rules
        if rule.name != CASCADE_RULE
    )
    if _dataset != "finance_transactions":
        CTES[f"issues_{_dataset}"] = f"SELECT * FROM own_issues_{_dataset}"

CTES["held_orders"] = "SELECT DISTINCT record_id FROM own_issues_orders WHERE action = 'QUARANTINE'"
CTES["cascaded"] = """
    SELECT f.* FROM uniq_finance_transactions f
    WHERE f.finance_transaction_id NOT IN
              (SELECT record_id FROM own_issues_finance_transactions WHERE action = 'QUARANTINE')
      AND f.order_id NOT IN
              (SELECT order_id FROM uniq_orders WHERE order_id NOT IN (SELECT record_id FROM held_orders))
"""
_cascade_rule = next(rule for rule in CATALOGUE["finance_transactions"] if rule.name == CASCADE_RULE)
CTES["issues_finance_transactions"] = (
    "SELECT * FROM own_issues_finance_transactions UNION ALL "
    + _issue_select("finance_transactions", _cascade_rule, 2, "cascaded", "true")
)
CTES["issues"] = " UNION ALL ".join(f"SELECT * FROM issues_{dataset}" for dataset in fixed.DATASETS)
CTES["kinds"] = (
    "SELECT dataset, issue_type, severity, action, count(*) AS issue_count FROM issues GROUP BY ALL"
)

# --- Types per record, loaded rows and quarantine --------------------------------

for _dataset in fixed.DATASETS:
    _key = fixed.KEYS[_dataset]
    CTES[f"types_{_dataset}"] = (
        "SELECT record_id, string_agg(issue_type, '|' ORDER BY issue_type) AS types,"
        " string_agg(DISTINCT issue_type, '|' ORDER BY issue_type) AS distinct_types,"
        f" bool_or(action = 'QUARANTINE') AS held FROM issues_{_dataset} GROUP BY record_id"
    )
    CTES[f"routed_{_dataset}"] = (
        f"SELECT j.*, coalesce(t.types, 'PASS') AS quality_flag, t.distinct_types AS quarantine_reason,"
        f" coalesce(t.held, false) AS held FROM judged_{_dataset} j LEFT JOIN types_{_dataset} t ON t.record_id = j.{_key}"
    )

CTES["dim_customer"] = """
    SELECT customer_id, trim(customer_name) AS customer_name, segment AS customer_segment,
           CASE WHEN trim(region) = '' THEN 'UNKNOWN' ELSE upper(trim(region)) END AS region,
           created_date, upper(trim(crm_status)) AS crm_status, quality_flag
    FROM routed_customers
"""
CTES["dim_product"] = f"""
    SELECT product_id, trim(product_name) AS product_name, category AS product_category,
           {_cents('unit_price')} AS unit_price_cents, {_cents('unit_cost')} AS unit_cost_cents,
           upper(trim(active_flag)) AS active_flag, quality_flag
    FROM routed_products
"""
CTES["fact_order"] = f"""
    SELECT order_id, customer_id, product_id, order_date, left(order_date, 7) AS order_month,
           CAST(units AS BIGINT) AS quantity, {_cents('unit_price')} AS unit_price_cents,
           CAST(round(discount * 10000, 0) AS BIGINT) AS discount_basis_points,
           {_cents('order_amount')} AS order_amount_cents, status AS order_status,
           upper(trim(channel)) AS channel, quality_flag
    FROM routed_orders WHERE NOT held
"""
CTES["fact_support_ticket"] = """
    SELECT ticket_id, customer_id, opened_at, left(opened_at, 7) AS opened_month,
           nullif(resolved_at, '') AS resolved_at, upper(trim(ticket_status)) AS ticket_status,
           governed_priority AS priority, upper(trim(issue_category)) AS issue_category,
           round(date_diff('second', opened, resolved) / 3600.0::DOUBLE, 2) AS resolution_hours,
           CASE WHEN satisfaction_score <> '' THEN coalesce(TRY_CAST(satisfaction_score AS INTEGER), 0) END AS satisfaction_score, quality_flag
    FROM routed_support_tickets WHERE NOT held
"""
CTES["fact_finance_transaction"] = """
    SELECT finance_transaction_id, order_id, posted_date, left(posted_date, 7) AS posted_month,
           governed_type AS transaction_type, ledger AS transaction_amount_cents,
           upper(trim(currency)) AS currency, upper(trim(posting_status)) AS posting_status, quality_flag
    FROM routed_finance_transactions WHERE NOT held
"""
CTES["order_quarantine"] = f"""
    SELECT order_id, nullif(customer_id, '') AS customer_id, nullif(product_id, '') AS product_id,
           nullif(order_date, '') AS order_date, {_cents('order_amount')} AS order_amount_cents,
           quarantine_reason
    FROM routed_orders WHERE held
"""
CTES["support_ticket_quarantine"] = """
    SELECT ticket_id, nullif(customer_id, '') AS customer_id, nullif(opened_at, '') AS opened_at,
           quarantine_reason
    FROM routed_support_tickets WHERE held
"""
CTES["finance_transaction_quarantine"] = """
    SELECT finance_transaction_id, nullif(order_id, '') AS order_id, nullif(posted_date, '') AS posted_date,
           ledger AS transaction_amount_cents, quarantine_reason
    FROM routed_finance_transactions WHERE held
"""
CTES["data_quality_exception"] = """
    SELECT printf('DQ%06d', row_number() OVER (
               ORDER BY phase, dataset_no, step, by_key, src_pass, k, rule_no)) AS exception_id,
           dataset, record_id, issue_type, severity, action, message
    FROM issues
"""


def _balance(dataset: str, unit: str, suffix: str, source: str, loaded: str, held: str, loaded_table: str, held_table: str) -> str:
    unreadable = "0" if unit == "COUNT" else f"(SELECT count(*) - {source.replace('sum(', 'count(', 1)} FROM uniq_{dataset})"
    return (
        f"SELECT '{dataset}_{suffix}' AS control_name, '{dataset}' AS dataset, '{unit}' AS unit,"
        f" CAST((SELECT {source} FROM uniq_{dataset}) AS BIGINT) AS source_value,"
        f" CAST((SELECT {loaded} FROM {loaded_table}) + (SELECT {held} FROM {held_table}) AS BIGINT) AS target_value, {unreadable} AS unreadable"
    )


_balances = [
    _balance("orders", "COUNT", "count", "count(*)", "count(*)", "count(*)", "fact_order", "order_quarantine"),
    _balance("orders", "CENTS", "amount_cents", f"sum({_cents('order_amount')})", "sum(order_amount_cents)",
             "coalesce(sum(order_amount_cents), 0)", "fact_order", "order_quarantine"),
    _balance("support_tickets", "COUNT", "count", "count(*)", "count(*)", "count(*)",
             "fact_support_ticket", "support_ticket_quarantine"),
    _balance("finance_transactions", "COUNT", "count", "count(*)", "count(*)", "count(*)",
             "fact_finance_transaction", "finance_transaction_quarantine"),
    _balance("finance_transactions", "CENTS", "amount_cents", f"sum({_cents('transaction_amount')})",
             "sum(transaction_amount_cents)", "coalesce(sum(transaction_amount_cents), 0)",
             "fact_finance_transaction", "finance_transaction_quarantine"),
]
CTES["etl_control"] = (
    "SELECT * EXCLUDE (unreadable), source_value - target_value AS difference,"
    " CASE WHEN source_value = target_value AND unreadable = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
    + " UNION ALL ".join(_balances) + ")"
)
_LOADED = {
    "customers": "dim_customer", "products": "dim_product", "orders": "fact_order",
    "support_tickets": "fact_support_ticket", "finance_transactions": "fact_finance_transaction",
}
_HELD = {
    "orders": "order_quarantine", "support_tickets": "support_ticket_quarantine",
    "finance_transactions": "finance_transaction_quarantine",
}
CTES["counts"] = " UNION ALL ".join(
    f"SELECT '{dataset}' AS dataset, (SELECT count(*) FROM raw_{dataset}) AS source_rows,"
    f" (SELECT count(*) FROM uniq_{dataset}) AS unique_rows,"
    f" (SELECT count(*) FROM {_LOADED[dataset]}) AS loaded_rows,"
    + (f" (SELECT count(*) FROM {_HELD[dataset]})" if dataset in _HELD else " 0")
    + f" AS quarantined_rows, (SELECT count(*) FROM uniq_{dataset} WHERE copies > 1 AND {fixed.KEYS[dataset]} <> '') AS duplicate_keys"
    for dataset in fixed.DATASETS
)
CTES["controls"] = """
    SELECT dataset, issue_type AS control, severity, action, issue_count,
           CASE action WHEN 'FAIL_PIPELINE' THEN 'FAIL' ELSE 'WARNING' END AS status
    FROM kinds
    UNION ALL
    SELECT 'enterprise', gate, 'CRITICAL', 'NONE', hits, CASE WHEN hits = 0 THEN 'PASS' ELSE 'FAIL' END
    FROM (
        SELECT 'PRIMARY_KEYS_PRESENT' AS gate,
               (SELECT count(*) FROM issues WHERE issue_type = 'MISSING_PRIMARY_KEY') AS hits
        UNION ALL SELECT 'DIMENSION_DOMAINS_VALID',
               (SELECT count(*) FROM issues
                WHERE dataset IN ('customers', 'products') AND issue_type = 'INVALID_CATEGORY')
        UNION ALL SELECT 'DIMENSION_AMOUNTS_VALID',
               (SELECT count(*) FROM issues WHERE issue_type = 'INVALID_PRODUCT_AMOUNT')
        UNION ALL SELECT 'SOURCE_FILES_READABLE', 0
        UNION ALL SELECT 'CRITICAL_ERROR_THRESHOLD',
               (SELECT count(*) FROM issues WHERE severity = 'CRITICAL')
    )
"""

# --- Data-quality answers ---------------------------------------------------------

ANSWERS["dq_duplicates"] = " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, {k} AS key_value, count(*) AS copies FROM raw_{d} WHERE {k} <> ''"
    f" GROUP BY {k} HAVING count(*) > 1"
    for d, k in fixed.KEYS.items()
)
ANSWERS["dq_missing_required"] = " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, {fixed.KEYS[d]} AS record_id, concat_ws('|', "
    + ", ".join(f"CASE WHEN {f} = '' THEN '{f}' END" for f in fields)
    + f") AS fields FROM raw_{d} WHERE '' IN ({', '.join(fields)})"
    for d, fields in REQUIRED.items()
)
ANSWERS["dq_invalid_fk"] = " UNION ALL ".join(
    f"SELECT '{child}' AS dataset, '{field}' AS field, {fixed.KEYS[child]} AS record_id, {field} AS value"
    f" FROM raw_{child} WHERE {field} <> ''"
    f" AND {field} NOT IN (SELECT {fixed.KEYS[parent]} FROM raw_{parent})"
    for child, field, parent in RAW_REFERENCES
)
ANSWERS["dedup_first"] = """
    SELECT * EXCLUDE (nth, l_shipdate), CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate
    FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                   ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                            l_discount, l_tax, l_returnflag, l_linestatus) AS nth,
               count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies
        FROM lineitem
    ) WHERE nth = 1
"""
ANSWERS["dq_issues"] = "SELECT dataset, record_id, issue_type, severity, action, message FROM issues"
ANSWERS["dq_exceptions"] = "SELECT * FROM data_quality_exception"
ANSWERS["dq_controls"] = "SELECT * FROM controls"
ANSWERS["dq_quarantine_ids"] = (
    "SELECT DISTINCT dataset, record_id FROM issues WHERE action = 'QUARANTINE'"
)
ANSWERS["dq_issue_map"] = " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, record_id, types AS issue_types FROM types_{d}" for d in fixed.DATASETS
)
ANSWERS["dq_issue_counts"] = "SELECT issue_type, count(*) AS issue_count FROM issues GROUP BY issue_type"
ANSWERS["exception_summary"] = (
    "SELECT dataset, issue_type, severity, action, issue_count AS exception_count FROM kinds"
)
ANSWERS["exception_rank"] = """
    SELECT *, dense_rank() OVER (PARTITION BY dataset ORDER BY exception_count DESC) AS issue_rank
    FROM (SELECT dataset, issue_type, count(*) AS exception_count FROM issues GROUP BY dataset, issue_type)
"""
ANSWERS["finance_cascade"] = (
    "SELECT finance_transaction_id, order_id, 'ORDER_NOT_LOADED' AS issue_type FROM cascaded"
)

# --- Warehouse answers ----------------------------------------------------------------

for _name, _table in {
    "wh_dim_customer": "dim_customer", "wh_dim_product": "dim_product", "wh_fact_order": "fact_order",
    "wh_fact_support_ticket": "fact_support_ticket", "wh_fact_finance": "fact_finance_transaction",
    "quarantine_orders": "order_quarantine", "quarantine_tickets": "support_ticket_quarantine",
    "quarantine_finance": "finance_transaction_quarantine", "recon_controls": "etl_control",
    "etl_counts": "counts",
}.items():
    ANSWERS[_name] = f"SELECT * FROM {_table}"
ANSWERS["control_listing"] = "SELECT * FROM etl_control ORDER BY control_name"
ANSWERS["quarantine_inventory"] = " UNION ALL ".join(
    f"SELECT '{dataset}' AS dataset, count(*) AS quarantined FROM {table}" for dataset, table in _HELD.items()
)
ANSWERS["key_audit"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, count(*) - count(DISTINCT {key}) AS repeated_keys FROM {table}"
    for table, key in audit.PRIMARY_KEYS.items()
)
_orphans = {
    control: f"SELECT '{control}' AS control_name, count(*) AS issue_count FROM {child} x"
             f" WHERE NOT EXISTS (SELECT 1 FROM {parent} y WHERE y.{column} = x.{column})"
    for control, child, column, parent in audit.REFERENCES
}
ANSWERS["reference_audit"] = " UNION ALL ".join(_orphans.values())
ANSWERS["fk_audit"] = " UNION ALL ".join(sql for name, sql in _orphans.items() if name != "TICKET_CUSTOMER_FK")
ANSWERS["range_audit"] = """
    SELECT count(*) FILTER (WHERE quantity <= 0) AS invalid_quantity,
           count(*) FILTER (WHERE order_amount_cents < 0) AS negative_order_amount,
           count(*) FILTER (WHERE discount_basis_points < 0 OR discount_basis_points > 10000) AS invalid_discount
    FROM fact_order
"""


def _constraints(table: str):
    for column in schemas.WAREHOUSE[table].names:
        if column not in audit.NULLABLE.get(table, ()):
            yield column, "NOT_NULL", f"{column} IS NULL"
    for column, domain in audit.DOMAINS.get(table, {}).items():
        yield column, "DOMAIN", f"{column} NOT IN {_list(domain)}"
    for column, rule in audit.RANGES.get(table, {}).items():
        yield column, "RANGE", f"NOT ({rule})"


ANSWERS["constraint_audit"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS check_name,"
    f" count(*) FILTER (WHERE {broken}) AS violations FROM {table}"
    for table in audit.PRIMARY_KEYS for column, kind, broken in _constraints(table)
)

# --- Analytics ---------------------------------------------------------------------------

_ORDER = f"""
    count(*) AS order_count, count(DISTINCT customer_id) AS customers,
    CAST(coalesce(sum(quantity), 0) AS BIGINT) AS units,
    CAST(coalesce(sum(order_amount_cents) FILTER (WHERE order_status IN {_list(fixed.FULFILLED)}), 0) AS BIGINT) AS fulfilled_cents,
    count(*) FILTER (WHERE order_status IN {_list(fixed.FULFILLED)}) AS fulfilled_orders,
    count(*) FILTER (WHERE order_status = 'CANCELLED') AS cancelled_orders
"""
_LEDGER = """
    CAST(coalesce(sum(transaction_amount_cents) FILTER (WHERE posting_status = 'POSTED'), 0) AS BIGINT) AS net_revenue_cents,
    count(*) FILTER (WHERE posting_status = 'PENDING') AS pending_transactions
"""
_SLA = "CASE priority WHEN 'CRITICAL' THEN 24 WHEN 'HIGH' THEN 48 WHEN 'MEDIUM' THEN 72 ELSE 120 END"
_SUPPORT = f"""
    count(*) AS ticket_volume,
    count(*) FILTER (WHERE ticket_status <> 'OPEN') AS resolved_count,
    CAST(coalesce(sum(CAST(round(resolution_hours * 100) AS BIGINT)), 0) AS BIGINT) AS hours_hundredths,
    count(*) FILTER (WHERE resolution_hours <= {_SLA}) AS within_sla,
    count(resolution_hours) AS eligible_sla
"""
CTES["all_orders"] = f"SELECT {_ORDER} FROM fact_order"
CTES["all_ledger"] = f"SELECT {_LEDGER} FROM fact_finance_transaction"
CTES["all_support"] = f"SELECT {_SUPPORT} FROM fact_support_ticket"
CTES["month_orders"] = f"SELECT order_month, {_ORDER} FROM fact_order GROUP BY order_month"
CTES["month_ledger"] = f"SELECT posted_month, {_LEDGER} FROM fact_finance_transaction GROUP BY posted_month"
CTES["month_support"] = f"SELECT opened_month, {_SUPPORT} FROM fact_support_ticket GROUP BY opened_month"
_AOV = _mean("fulfilled_cents", "fulfilled_orders")
_HOURS = _mean("hours_hundredths", "eligible_sla")
_HOURS_OR_NULL = f"(CAST({_half_up('hours_hundredths', 'eligible_sla')} AS BIGINT) / 100.0::DOUBLE)"

ANSWERS["kpi_orders"] = """
    SELECT order_count, customers AS ordering_customers, fulfilled_cents AS fulfilled_value_cents,
           fulfilled_cents::DOUBLE / nullif(fulfilled_orders, 0) AS average_order_cents, cancelled_orders
    FROM all_orders
"""
ANSWERS["kpi_finance"] = "SELECT * FROM all_ledger"
ANSWERS["kpi_support"] = f"""
    SELECT ticket_volume AS ticket_count, resolved_count, {_HOURS} AS average_resolution_hours,
           within_sla, eligible_sla
    FROM all_support
"""
CTES["score"] = f"""
    SELECT total_records, critical_issues, quarantined_records, remediated_issues, exception_count,
           CASE WHEN total_records = 0 THEN 0.0::DOUBLE ELSE
           {_pct('greatest(100 * total_records - (500 * critical_issues + 150 * quarantined_records + 25 * remediated_issues), 0)',
                 '(100 * total_records)')} END AS data_quality_score
    FROM (
        SELECT CAST((SELECT sum(unique_rows) FROM counts) AS BIGINT) AS total_records,
               (SELECT count(*) FROM issues WHERE severity = 'CRITICAL') AS critical_issues,
               CAST((SELECT sum(quarantined_rows) FROM counts) AS BIGINT) AS quarantined_records,
               (SELECT count(*) FROM issues WHERE action IN {_list(fixed.REMEDIATION_ACTIONS)}) AS remediated_issues,
               (SELECT count(*) FROM issues) AS exception_count
    )
"""
ANSWERS["quality_score"] = "SELECT * FROM score"
CTES["overall"] = f"""
    SELECT {_dollars('net_revenue_cents')} AS net_revenue, {_dollars('fulfilled_cents')} AS fulfilled_order_value,
           order_count, {_AOV} AS average_order_value, customers AS ordering_customer_count, ticket_volume,
           {_pct0('resolved_count', 'ticket_volume')} AS ticket_resolution_rate,
           {_HOURS} AS average_resolution_hours, {_pct0('within_sla', 'eligible_sla')} AS ticket_sla_rate,
           {_pct0('cancelled_orders', 'order_count')} AS cancellation_rate,
           pending_transactions AS pending_finance_transactions, exception_count,
           quarantined_records AS quarantined_record_count, data_quality_score
    FROM all_orders, all_ledger, all_support, score
"""
ANSWERS["kpi_overall"] = "SELECT * FROM overall"
ANSWERS["executive_kpis"] = f"""
    SELECT order_count, customers AS ordering_customers, {_dollars('fulfilled_cents')} AS fulfilled_order_value,
           fulfilled_cents::DOUBLE / nullif(fulfilled_orders, 0) / 100.0::DOUBLE AS average_order_value,
           {_pct('cancelled_orders', 'order_count')} AS cancellation_rate,
           {_dollars('net_revenue_cents')} AS net_revenue, ticket_volume,
           {_pct('resolved_count', 'ticket_volume')} AS ticket_resolution_rate,
           {_HOURS_OR_NULL} AS average_resolution_hours
    FROM all_orders, all_ledger, all_support
"""
ANSWERS["monthly_orders"] = "SELECT * FROM month_orders"
ANSWERS["monthly_finance"] = "SELECT * FROM month_ledger"
ANSWERS["monthly_support"] = "SELECT * FROM month_support"
CTES["calendar"] = """
    SELECT o.*, s.* EXCLUDE (opened_month), coalesce(l.net_revenue_cents, 0) AS net_cents,
           lag(coalesce(l.net_revenue_cents, 0)) OVER (ORDER BY o.order_month) AS prior_cents,
           lag(o.order_count) OVER (ORDER BY o.order_month) AS prior_orders
    FROM month_orders o
    LEFT JOIN month_ledger l ON l.posted_month = o.order_month
    LEFT JOIN month_support s ON s.opened_month = o.order_month
"""
CTES["trend_base"] = f"""
    SELECT *, ({_dollars('net_cents')} - avg({_dollars('net_cents')}) OVER ())
              / CASE stddev_pop({_dollars('net_cents')}) OVER () WHEN 0 THEN 1
                     ELSE stddev_pop({_dollars('net_cents')}) OVER () END AS z
    FROM calendar
"""
CTES["trends"] = f"""
    SELECT order_month AS reporting_month, order_count, customers AS unique_customers, units AS units_sold,
           {_dollars('fulfilled_cents')} AS fulfilled_order_value, {_dollars('net_cents')} AS net_revenue,
           {_pct('(net_cents - prior_cents)', 'abs(prior_cents)')} AS revenue_mom_growth_pct,
           {_AOV} AS average_order_value, {_pct('cancelled_orders', 'order_count')} AS cancellation_rate,
           coalesce(ticket_volume, 0) AS ticket_volume,
           {_pct0('resolved_count', 'ticket_volume')} AS ticket_resolution_rate,
           {_pct0('within_sla', 'eligible_sla')} AS ticket_sla_rate, {_HOURS} AS average_resolution_hours,
           round(z, 2) + 0.0 AS revenue_zscore,
           CASE WHEN abs(z) >= 2 THEN 'Y' ELSE 'N' END AS revenue_anomaly_flag
    FROM trend_base
"""
ANSWERS["monthly_trends"] = "SELECT * FROM trends"
ANSWERS["mom_growth"] = f"""
    SELECT order_month AS reporting_month, order_count, {_dollars('fulfilled_cents')} AS fulfilled_value,
           {_dollars('net_cents')} AS net_revenue,
           {_pct('(order_count - prior_orders)', 'prior_orders')} AS order_growth_pct,
           {_pct('(net_cents - prior_cents)', 'abs(prior_cents)')} AS revenue_growth_pct
    FROM calendar
"""
CTES["rich_orders"] = """
    SELECT o.*, c.customer_segment, c.customer_name, p.product_category
    FROM fact_order o JOIN dim_customer c USING (customer_id) JOIN dim_product p USING (product_id)
"""
CTES["ledger_orders"] = """
    SELECT o.*, CASE WHEN f.posting_status = 'POSTED' THEN f.transaction_amount_cents ELSE 0 END AS posted_cents
    FROM rich_orders o LEFT JOIN fact_finance_transaction f USING (order_id)
"""
CTES["safe_ledger_orders"] = """
    SELECT o.*, coalesce(f.posted_cents, 0) AS posted_cents
    FROM rich_orders o LEFT JOIN (
        SELECT order_id, sum(transaction_amount_cents) FILTER (WHERE posting_status = 'POSTED') AS posted_cents
        FROM fact_finance_transaction GROUP BY order_id
    ) f USING (order_id)
"""


def _categories(source: str) -> str:
    return f"""
        SELECT product_category, order_count, customers, units AS units_sold,
               {_dollars('fulfilled_cents')} AS fulfilled_order_value, {_dollars('posted')} AS net_revenue
        FROM (SELECT product_category, {_ORDER}, sum(posted_cents) AS posted FROM {source} GROUP BY product_category)
    """


def _dashboard(source: str) -> str:
    return f"""
        SELECT order_month AS reporting_month, product_category, order_count, customers AS unique_customers,
               units AS units_sold, {_dollars('fulfilled_cents')} AS fulfilled_order_value,
               {_dollars('posted')} AS net_revenue, {_AOV} AS average_order_value,
               {_pct('cancelled_orders', 'order_count')} AS cancellation_rate
        FROM (SELECT order_month, product_category, {_ORDER}, sum(posted_cents) AS posted
              FROM {source} GROUP BY order_month, product_category)
    """


CTES["categories"] = _categories("ledger_orders")
ANSWERS["category_performance"] = "SELECT * FROM categories"
ANSWERS["category_performance_grain_safe"] = _categories("safe_ledger_orders")
ANSWERS["dashboard_dataset"] = _dashboard("ledger_orders")
ANSWERS["dashboard_dataset_grain_safe"] = _dashboard("safe_ledger_orders")
CTES["segments"] = f"""
    SELECT customer_segment, order_count, customers, {_dollars('fulfilled_cents')} AS fulfilled_order_value,
           {_AOV} AS average_order_value, customers_with_tickets
    FROM (
        SELECT c.customer_segment, count(o.order_id) AS order_count, count(DISTINCT o.customer_id) AS customers,
               sum(o.order_amount_cents) FILTER (WHERE o.order_status IN {_list(fixed.FULFILLED)}) AS fulfilled_cents,
               count(*) FILTER (WHERE o.order_status IN {_list(fixed.FULFILLED)}) AS fulfilled_orders
        FROM dim_customer c LEFT JOIN fact_order o USING (customer_id) GROUP BY c.customer_segment
    ) JOIN (
        SELECT c.customer_segment, count(DISTINCT t.customer_id) AS customers_with_tickets
        FROM dim_customer c LEFT JOIN fact_support_ticket t USING (customer_id) GROUP BY c.customer_segment
    ) USING (customer_segment)
"""
ANSWERS["segment_metrics"] = "SELECT * FROM segments"
ANSWERS["segment_having"] = f"""
    SELECT customer_segment, order_count, customers AS ordering_customers,
           {_dollars('fulfilled_cents')} AS fulfilled_value
    FROM (SELECT customer_segment, {_ORDER} FROM rich_orders GROUP BY customer_segment HAVING count(*) >= 100)
"""
ANSWERS["category_rank_share"] = f"""
    SELECT product_category, order_count, units, {_dollars('fulfilled_cents')} AS fulfilled_value,
           dense_rank() OVER (ORDER BY fulfilled_cents DESC) AS revenue_rank,
           {_pct('fulfilled_cents', 'total')} AS revenue_share_pct
    FROM (SELECT *, sum(fulfilled_cents) OVER () AS total
          FROM (SELECT product_category, {_ORDER} FROM rich_orders GROUP BY product_category))
"""
ANSWERS["sla_by_priority"] = f"""
    SELECT priority, ticket_volume, resolved_count AS resolved_tickets,
           {_HOURS_OR_NULL} AS average_resolution_hours, {_pct('within_sla', 'eligible_sla')} AS sla_rate
    FROM (SELECT priority, {_SUPPORT} FROM fact_support_ticket GROUP BY priority)
"""
ANSWERS["enriched_orders"] = f"""
    SELECT order_month, product_category, customer_segment, order_count, customers, units,
           {_dollars('fulfilled_cents')} AS fulfilled_value
    FROM (SELECT order_month, product_category, customer_segment, {_ORDER} FROM rich_orders GROUP BY 1, 2, 3)
"""
ANSWERS["finance_variance"] = f"""
    SELECT finance_transaction_id, order_id, CAST(expected_cents AS BIGINT) AS expected_cents,
           transaction_amount_cents, CAST(transaction_amount_cents - expected_cents AS BIGINT) AS variance_cents
    FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY posted_date, finance_transaction_id) AS nth
        FROM fact_finance_transaction
    ) JOIN (
        SELECT order_id, CASE WHEN order_status IN {_list(fixed.FULFILLED)} THEN order_amount_cents
                              WHEN order_status = 'RETURNED' THEN -order_amount_cents ELSE 0 END AS expected_cents
        FROM fact_order
    ) USING (order_id)
    WHERE nth = 1 AND transaction_amount_cents <> expected_cents
"""
ANSWERS["top_customers"] = f"""
    SELECT customer_segment, customer_id, customer_name, {_dollars('value_cents')} AS fulfilled_value,
           rank() OVER (PARTITION BY customer_segment ORDER BY value_cents DESC) AS value_rank,
           row_number() OVER (PARTITION BY customer_segment ORDER BY value_cents DESC, customer_id) AS row_number
    FROM (
        SELECT customer_segment, customer_id, customer_name,
               sum(CASE WHEN order_status IN {_list(fixed.FULFILLED)} THEN order_amount_cents ELSE 0 END) AS value_cents
        FROM rich_orders GROUP BY 1, 2, 3
    )
    QUALIFY row_number() OVER (PARTITION BY customer_segment ORDER BY value_cents DESC, customer_id) <= 5
"""


def _best(source: str, label: str, name: str, value: str, direction: str = "DESC") -> str:
    return (
        f"(SELECT '{label}' AS highlight, {name} AS name, CAST({value} AS DOUBLE) AS value"
        f" FROM {source} ORDER BY {value} {direction}, {name} LIMIT 1)"
    )


ANSWERS["highlights"] = " UNION ALL ".join([
    _best("categories", "top_category", "product_category", "net_revenue"),
    _best("segments", "top_segment", "customer_segment", "fulfilled_order_value"),
    _best("trends", "highest_revenue_month", "reporting_month", "net_revenue"),
    _best("trends", "lowest_sla_month", "reporting_month", "ticket_sla_rate", "ASC"),
])

# --- Profiles -----------------------------------------------------------------------------


def _columns(dataset: str) -> tuple[str, ...]:
    return fixed.RAW_COLUMNS[dataset]


CTES["profiles"] = " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, count(*) AS row_count, CAST({len(_columns(d))} AS BIGINT) AS column_count,"
    f" count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_columns(d))} FROM raw_{d})) AS duplicate_row_count,"
    f" (SELECT count(*) FROM (SELECT {k} FROM raw_{d} WHERE {k} <> '' GROUP BY 1 HAVING count(*) > 1)) AS duplicate_primary_key_count,"
    f" '{k}' AS primary_key FROM raw_{d}"
    for d, k in fixed.KEYS.items()
)
ANSWERS["profile_tables"] = "SELECT * FROM profiles"


def _profile_column(d: str, c: str) -> str:
    n = _number(c)
    numeric = f"count(*) FILTER (WHERE {c} <> '') = count({n}) AND count({n}) > 0"
    scaled = f"CAST(sum({n}) * 1000000 AS HUGEINT)"
    mean = f"CAST({_half_up(scaled, f'(100 * count({n}))')} AS BIGINT) / 10000.0::DOUBLE"
    total = f"CAST({_half_up(scaled, '10000')} AS BIGINT) / 100.0::DOUBLE"
    return (
        f"SELECT '{d}' AS dataset, '{c}' AS column_name, count(*) FILTER (WHERE {c} = '') AS null_count,"
        f" count(DISTINCT {c}) FILTER (WHERE {c} <> '') AS unique_count,"
        f" count(*) FILTER (WHERE {c} <> '') - count(DISTINCT {c}) FILTER (WHERE {c} <> '') AS duplicate_value_count,"
        f" min({c}) FILTER (WHERE {c} <> '') AS min_value, max({c}) FILTER (WHERE {c} <> '') AS max_value,"
        f" CASE WHEN {numeric} THEN count({n}) END AS numeric_count,"
        f" CASE WHEN {numeric} THEN CAST(min({n}) AS DOUBLE) END AS numeric_min,"
        f" CASE WHEN {numeric} THEN CAST(max({n}) AS DOUBLE) END AS numeric_max,"
        f" CASE WHEN {numeric} THEN {mean} END AS numeric_mean,"
        f" CASE WHEN {numeric} THEN {total} END AS numeric_sum FROM raw_{d}"
    )


ANSWERS["profile_columns"] = " UNION ALL ".join(
    _profile_column(d, c) for d in fixed.DATASETS for c in _columns(d)
)
ANSWERS["profile_top_values"] = " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{d}' AS dataset, '{c}' AS column_name,"
    f" row_number() OVER (ORDER BY count(*) DESC, {c}) AS rank, {c} AS value, count(*) AS value_count"
    f" FROM raw_{d} WHERE {c} <> '' GROUP BY {c}) WHERE rank <= 10"
    for d in fixed.DATASETS for c in _columns(d)
)
CTES["profile_sums"] = (
    "SELECT CAST(sum(row_count) AS BIGINT) AS rows_profiled, CAST(sum(duplicate_row_count) AS BIGINT) AS duplicate_rows,"
    " CAST(" + " + ".join(
        "(SELECT " + " + ".join(f"count(*) FILTER (WHERE {c} = '')" for c in _columns(d)) + f" FROM raw_{d})"
        for d in fixed.DATASETS
    ) + " AS BIGINT) AS null_cells FROM profiles"
)
ANSWERS["profile_totals"] = "SELECT * FROM profile_sums"

# --- Reports ------------------------------------------------------------------------------

ANSWERS["kpi_summary"] = " UNION ALL ".join(
    f"SELECT '{name}' AS kpi_name, CAST({name} AS DOUBLE) AS kpi_value, '{unit}' AS unit,"
    f" '{definition}' AS definition FROM overall"
    for name, unit, definition in fixed.KPIS
)
ANSWERS["top_issues"] = """
    SELECT issue_type,
           array_to_string(list_transform(string_split(issue_type, '_'),
               lambda w: w[1] || lower(w[2:])), ' ') AS label,
           count(*) AS issue_count
    FROM issues GROUP BY issue_type ORDER BY issue_count DESC, issue_type LIMIT 6
"""
ANSWERS["control_outcomes"] = " UNION ALL ".join(
    f"SELECT '{status}' AS status, count(*) FILTER (WHERE status = '{status}') AS control_count FROM controls"
    for status in ("PASS", "WARNING", "FAIL")
)
CTES["gate"] = """
    SELECT (SELECT count(*) FROM issues WHERE action = 'FAIL_PIPELINE') AS critical_errors,
           count(*) FILTER (WHERE status <> 'PASS') AS failed_reconciliations, count(*) AS reconciliations
    FROM etl_control
"""
ANSWERS["publish_status"] = """
    SELECT *, CASE WHEN critical_errors + failed_reconciliations = 0 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM gate
"""
CTES["statements"] = """
    SELECT 1 AS place, printf('Track remediation by source owner until the issue-weighted quality score improves from %.2f%%.', data_quality_score) AS finding
    FROM overall WHERE data_quality_score < 99
    UNION ALL
    SELECT 2, printf('Add master-data validation at ingestion for the %d invalid customer/product references detected across operational sources.', count(*))
    FROM issues WHERE issue_type IN ('INVALID_CUSTOMER_REFERENCE', 'INVALID_PRODUCT_REFERENCE') HAVING count(*) > 0
    UNION ALL
    SELECT 3, printf('Route the %d order-to-ledger amount differences to finance reconciliation before period close.', count(*))
    FROM issues WHERE issue_type = 'FINANCE_ORDER_AMOUNT_MISMATCH' HAVING count(*) > 0
    UNION ALL
    SELECT 4, printf('Review staffing and escalation rules because only %.2f%% of eligible tickets met the priority-based SLA.', ticket_sla_rate)
    FROM overall WHERE ticket_sla_rate < 90
    UNION ALL
    SELECT 5, printf('Analyze cancellation drivers by channel and segment; the current rate is %.2f%%.', cancellation_rate)
    FROM overall WHERE cancellation_rate >= 8
    UNION ALL
    SELECT 6, printf('Investigate revenue mix and postings for statistically unusual month(s): %s.',
                     string_agg(reporting_month, ', ' ORDER BY reporting_month))
    FROM trends WHERE revenue_anomaly_flag = 'Y' HAVING count(*) > 0
"""
ANSWERS["findings"] = """
    SELECT row_number() OVER (ORDER BY place) AS finding_no, finding FROM statements
    UNION ALL
    SELECT 1, 'Continue monthly monitoring of quality controls, revenue, orders, and support performance.'
    WHERE NOT EXISTS (SELECT 1 FROM statements)
"""


def _whole(value: str) -> str:
    return f"format('{{:,}}', CAST({value} AS BIGINT))"


def _money_text(value: str) -> str:
    cents = f"CAST(round({value} * 100) AS BIGINT)"
    return (
        f"CASE WHEN {cents} < 0 THEN '$-' ELSE '$' END || format('{{:,}}', abs({cents}) // 100)"
        f" || '.' || lpad(CAST(abs({cents}) % 100 AS VARCHAR), 2, '0')"
    )


def _rate_text(value: str) -> str:
    return f"printf('%.2f', {value})"


def _pick(source: str, order: str, expression: str) -> str:
    return f"(SELECT {expression} FROM {source} ORDER BY {order} LIMIT 1)"


def _of_controls(status: str) -> str:
    return f"(SELECT {_whole('count(*)')} FROM controls WHERE status = '{status}')"


_BY_CATEGORY = ("categories", "net_revenue DESC, product_category")
_BY_SEGMENT = ("segments", "fulfilled_order_value DESC, customer_segment")
_BY_REVENUE = ("trends", "net_revenue DESC, reporting_month")
_BY_SLA = ("trends", "ticket_sla_rate, reporting_month")
_FACTS = (
    ("executive_summary", "raw_rows", _whole("rows_profiled")),
    ("executive_summary", "net_revenue", _money_text("net_revenue")),
    ("executive_summary", "loaded_orders", _whole("order_count")),
    ("executive_summary", "data_quality_score", _rate_text("data_quality_score")),
    ("executive_summary", "reconciliation_status", "CASE WHEN failed_reconciliations = 0 THEN 'PASS' ELSE 'FAIL' END"),
    ("data_quality", "duplicate_rows", _whole("duplicate_rows")),
    ("data_quality", "blank_cells", _whole("null_cells")),
    ("data_quality", "exceptions", _whole("exception_count")),
    ("data_quality", "quarantined_records", _whole("quarantined_record_count")),
    ("data_quality", "critical_errors", _whole("critical_errors")),
    ("data_quality", "controls_passed", _of_controls("PASS")),
    ("data_quality", "controls_warning", _of_controls("WARNING")),
    ("data_quality", "controls_failed", _of_controls("FAIL")),
    ("operations", "fulfilled_order_value", _money_text("fulfilled_order_value")),
    ("operations", "average_order_value", _money_text("average_order_value")),
    ("operations", "cancellation_rate", _rate_text("cancellation_rate")),
    ("operations", "ticket_volume", _whole("ticket_volume")),
    ("operations", "ticket_resolution_rate", _rate_text("ticket_resolution_rate")),
    ("operations", "average_resolution_hours", _rate_text("average_resolution_hours")),
    ("operations", "ticket_sla_rate", _rate_text("ticket_sla_rate")),
    ("customers", "ordering_customers", _whole("ordering_customer_count")),
    ("customers", "top_segment", _pick(*_BY_SEGMENT, "customer_segment")),
    ("customers", "top_segment_value", _pick(*_BY_SEGMENT, _money_text("fulfilled_order_value"))),
    ("customers", "top_segment_orders", _pick(*_BY_SEGMENT, _whole("order_count"))),
    ("products", "top_category", _pick(*_BY_CATEGORY, "product_category")),
    ("products", "top_category_revenue", _pick(*_BY_CATEGORY, _money_text("net_revenue"))),
    ("products", "top_category_orders", _pick(*_BY_CATEGORY, _whole("order_count"))),
    ("products", "top_category_units", _pick(*_BY_CATEGORY, _whole("units_sold"))),
    ("trends", "highest_revenue_month", _pick(*_BY_REVENUE, "reporting_month")),
    ("trends", "highest_revenue", _pick(*_BY_REVENUE, _money_text("net_revenue"))),
    ("trends", "lowest_sla_month", _pick(*_BY_SLA, "reporting_month")),
    ("trends", "lowest_sla_rate", _pick(*_BY_SLA, _rate_text("ticket_sla_rate"))),
    ("exceptions", "reconciliation_controls", _whole("reconciliations")),
)
CTES["headline"] = "SELECT * FROM overall, profile_sums, gate"
ANSWERS["report_facts"] = " UNION ALL ".join(
    f"SELECT '{section}' AS section, '{fact}' AS fact, {sql} AS value FROM headline"
    for section, fact, sql in _FACTS
)

# --- Assembly -----------------------------------------------------------------------------

_WORD = re.compile(r"[a-z_]+")


def _needed(sql: str, steps: dict[str, str]) -> list[str]:
    """Names of the steps a statement builds on, in definition order."""
    wanted, pending = set(), [sql]
    while pending:
        for name in set(_WORD.findall(pending.pop())) & steps.keys() - wanted:
            wanted.add(name)
            pending.append(steps[name])
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in sorted(set(_WORD.findall(steps[name])) & steps.keys() - {name}):
            if other not in ordered:
                add(other)
        if name not in ordered:
            ordered.append(name)

    for name in sorted(wanted):
        add(name)
    return ordered


def _statement(sql: str, steps: dict[str, str]) -> str:
    parts = ", ".join(f"{step} AS MATERIALIZED ({steps[step]})" for step in _needed(sql, steps))
    return f"WITH {parts} {sql}" if parts else sql


def _damaged() -> dict[str, str]:
    """All steps, with damage planted in the loaded tables."""
    steps = dict(CTES)
    for table, (changes, twice) in DAMAGE.items():
        columns = ", ".join(f"{changes.get(c, c)} AS {c}" for c in schemas.WAREHOUSE[table].names)
        steps[f"sound_{table}"] = CTES[table]
        steps[table] = f"SELECT {columns} FROM (SELECT * FROM sound_{table} UNION ALL SELECT * FROM sound_{table} WHERE {twice})"
    return steps


def _conserved(dataset: str, fact: str, held: str, raw: str | None, typed: str | None) -> str:
    """Whether raw records are the loaded, the quarantined and the dropped copies, each by key and cents."""
    key, columns = fixed.KEYS[dataset], ", ".join(fixed.RAW_COLUMNS[dataset])
    of_raw = f"coalesce({key}, '') AS key, {_cents(raw) if raw else 'NULL'} AS cents"
    of_typed = f"coalesce({key}, '') AS key, {typed or 'NULL'} AS cents"
    source = f"SELECT {of_raw} FROM raw_{dataset}"
    ranked = f"SELECT *, row_number() OVER (PARTITION BY coalesce({key}, '') ORDER BY src_pass, k, {columns}) AS nth FROM raw_{dataset}"
    target = (
        f"SELECT {of_typed} FROM {fact} UNION ALL SELECT {of_typed} FROM {held} UNION ALL SELECT {of_raw} FROM ({ranked}) WHERE nth > 1"
    )
    return (
        f"SELECT '{dataset}_rows' AS control_name, '{dataset}' AS dataset, (SELECT count(*) FROM ({source})) AS source_rows,"
        f" (SELECT count(*) FROM ({target})) AS target_rows, CASE WHEN EXISTS ({source} EXCEPT ALL ({target}))"
        f" OR EXISTS (SELECT * FROM ({target}) EXCEPT ALL ({source})) THEN 'FAIL' ELSE 'PASS' END AS status"
    )


ANSWERS["recon_rows"] = ANSWERS["published_conservation"] = " UNION ALL ".join(
    [
        _conserved("orders", "fact_order", "order_quarantine", "order_amount", "order_amount_cents"),
        _conserved("support_tickets", "fact_support_ticket", "support_ticket_quarantine", None, None),
        _conserved("finance_transactions", "fact_finance_transaction", "finance_transaction_quarantine", "transaction_amount", "transaction_amount_cents"),
    ]
)
ANSWERS["csv_documents"] = (
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(lang, '') AS lang, nullif(source, '') AS source,"
    " CAST(n_chars AS VARCHAR) AS n_chars, nullif(text, '') AS text FROM documents"
)

_PUBLISHED = {
    "orders": "fact_order", "tickets": "fact_support_ticket", "ledger": "fact_finance_transaction",
    "order_quarantine": "order_quarantine", "exceptions": "data_quality_exception", "controls": "etl_control",
    "categories": "categories", "segments": "segments",
}


def oracles() -> dict[str, str]:
    found = {name: _statement(sql, CTES) for name, sql in ANSWERS.items()}
    dirty, damaged = {**CTES, **_raw(DIRTY_RECIPES)}, _damaged()
    found |= {f"dirty_{name}": _statement(ANSWERS[name], dirty) for name in DIRTY}
    found |= {f"damaged_{name}": _statement(ANSWERS[name], damaged) for name in DAMAGED}
    found |= {f"published_{name}": _statement(f"SELECT * FROM {table}", CTES) for name, table in _PUBLISHED.items()}
    rows = " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in schemas.WAREHOUSE)
    found["published_inventory"] = _statement(rows, CTES)
    return found
