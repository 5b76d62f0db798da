"""Deduplicate, parse, standardize and judge every record in one pass.

Each function returns the whole deduplicated source: typed warehouse columns,
the finding mask, and what later steps need, so that loaded rows, quarantine,
findings and reconciliation are all narrow reads of one table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleargrain.functions import clean, fixed
from cleargrain.functions.clean import is_blank
from cleargrain.operators.reconcile import DROPPED, source_fingerprints
from cleargrain.operators.records import hot_keys, keep_first, lookup
from cleargrain.operators.rules import CASCADE_RULE, MASK, flags_with, has_any, with_mask
from cleargrain.sources.raw import ROW_ORDER


def _first_rows(dataset: str, source: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """Contract columns of the first row per key, blank text as found, and fingerprints of the copies dropped for it."""
    columns = fixed.RAW_COLUMNS[dataset]
    dropped = dict(zip(DROPPED, source_fingerprints(dataset), strict=True))
    return keep_first(source.select(*columns, ROW_ORDER), [columns[0]], [ROW_ORDER], dropped, repeated)


def _key_hits(dataset: str) -> dict[str, Column]:
    blank = is_blank(F.col(fixed.KEYS[dataset]))
    return {"repeated_key": ~blank & (F.col("copies") > 1), "missing_key": blank}


def _required(*columns: str) -> dict[str, Column]:
    return {f"no_{column}": is_blank(F.col(column)) for column in columns}


def _is_alias(raw: str, governed: Column, domain: tuple[str, ...]) -> Column:
    return governed.isin(*domain) & ~F.equal_null(F.col(raw), governed)


def _upper(column: str) -> Column:
    return F.upper(clean.strip(F.col(column)))


def _score(column: str) -> Column:
    """Whole-number score; unreadable text becomes 0, which the range audit rejects."""
    return F.coalesce(clean.strip(F.col(column)).try_cast("int"), F.lit(0))


def validate_customers(source: DataFrame, *, repeated: DataFrame | None = None) -> DataFrame:
    rows = _first_rows("customers", source, repeated).withColumn(
        "segment", clean.customer_segment(F.col("customer_segment"))
    )
    known = F.col("segment").isin(*fixed.SEGMENTS)
    hits = {
        **_key_hits("customers"),
        **_required("customer_name", "customer_segment", "created_date", "crm_status"),
        "bad_created_date": ~is_blank(F.col("created_date")) & clean.iso_date(F.col("created_date")).isNull(),
        "unknown_segment": ~known,
        "alias_segment": _is_alias("customer_segment", F.col("segment"), fixed.SEGMENTS),
        "no_region": is_blank(F.col("region")),
    }
    return with_mask("customers", rows, hits).select(
        "customer_id",
        clean.strip(F.col("customer_name")).alias("customer_name"),
        F.col("segment").alias("customer_segment"),
        F.coalesce(clean.null_if_blank(_upper("region")), F.lit("UNKNOWN")).alias("region"),
        "created_date",
        _upper("crm_status").alias("crm_status"),
        MASK,
        ROW_ORDER, "copies", *DROPPED,
    )


def validate_products(source: DataFrame, *, repeated: DataFrame | None = None) -> DataFrame:
    rows = _first_rows("products", source, repeated).select(
        "*",
        clean.product_category(F.col("product_category")).alias("category"),
        clean.to_decimal(F.col("unit_price")).alias("price"),
        clean.to_decimal(F.col("unit_cost")).alias("cost"),
    )
    price, cost = F.col("price"), F.col("cost")
    sound = F.coalesce((price > 0) & (cost >= 0) & (cost <= price), F.lit(False))
    hits = {
        **_key_hits("products"),
        **_required("product_name", "product_category", "unit_price", "unit_cost", "active_flag"),
        "unknown_category": ~F.col("category").isin(*fixed.CATEGORIES),
        "alias_category": _is_alias("product_category", F.col("category"), fixed.CATEGORIES),
        "bad_price": ~sound,
        "unusual_price": sound & (price > fixed.UNUSUAL_UNIT_PRICE),
    }
    return with_mask("products", rows, hits).select(
        "product_id",
        clean.strip(F.col("product_name")).alias("product_name"),
        F.col("category").alias("product_category"),
        clean.cents(price).alias("unit_price_cents"),
        clean.cents(cost).alias("unit_cost_cents"),
        _upper("active_flag").alias("active_flag"),
        MASK,
        ROW_ORDER, "copies", *DROPPED,
    )


def validate_orders(source: DataFrame, customers: DataFrame, products: DataFrame, *, repeated: DataFrame | None = None) -> DataFrame:
    rows = _first_rows("orders", source, repeated)
    rows = lookup(
        rows, "customer_id", "order_id", customers, "customer_id",
        {"customer_segment": "customer_segment", "region": "region"}, "customer_found",
        hot_keys(source, "customer_id"),
    )
    rows = lookup(
        rows, "product_id", "order_id", products, "product_id",
        {"product_category": "product_category"}, "product_found", hot_keys(source, "product_id"),
    )
    rows = rows.select(
        "*",
        clean.order_status(F.col("order_status")).alias("status"),
        clean.to_decimal(F.col("quantity")).alias("units"),
        clean.to_decimal(F.col("order_amount")).alias("amount"),
        clean.to_decimal(F.col("unit_price")).alias("price"),
        clean.to_decimal(F.col("discount_rate")).alias("discount"),
    )
    units, amount = F.col("units"), F.col("amount")
    whole_units = F.coalesce((units > 0) & (units == F.floor(units)), F.lit(False))
    fair_price = F.coalesce((F.col("price") > 0) & F.col("discount").between(0, 1), F.lit(False))
    no_customer = is_blank(F.col("customer_id"))
    hits = {
        **_key_hits("orders"),
        "no_customer": no_customer,
        "unknown_customer": ~no_customer & ~F.col("customer_found"),
        "unknown_product": ~F.col("product_found"),
        "bad_order_date": clean.iso_date(F.col("order_date")).isNull(),
        "bad_quantity": ~whole_units,
        "bad_amount": ~F.coalesce(amount >= 0, F.lit(False)),
        "bad_price_or_discount": ~fair_price,
        "unusual_amount": amount > fixed.UNUSUAL_ORDER_AMOUNT,
        "unknown_status": ~F.col("status").isin(*fixed.ORDER_STATUSES),
        "alias_status": _is_alias("order_status", F.col("status"), fixed.ORDER_STATUSES),
    }
    return with_mask("orders", rows, hits).select(
        "order_id", "customer_id", "product_id", "order_date",
        clean.month(F.col("order_date")).alias("order_month"),
        units.try_cast("bigint").alias("quantity"),
        clean.cents(F.col("price")).alias("unit_price_cents"),
        clean.basis_points(F.col("discount")).alias("discount_basis_points"),
        clean.cents(amount).alias("order_amount_cents"),
        F.col("order_amount").alias("source_amount"),
        F.col("status").alias("order_status"),
        _upper("channel").alias("channel"),
        "customer_segment", "region", "product_category",
        MASK,
        ROW_ORDER, "copies", *DROPPED,
    )


def validate_tickets(source: DataFrame, customers: DataFrame, *, repeated: DataFrame | None = None) -> DataFrame:
    rows = lookup(
        _first_rows("support_tickets", source, repeated), "customer_id", "ticket_id", customers, "customer_id",
        {"customer_segment": "customer_segment"}, "customer_found", hot_keys(source, "customer_id"),
    ).select(
        "*",
        clean.priority(F.col("priority")).alias("governed_priority"),
        clean.iso_datetime(F.col("opened_at")).alias("opened"),
        clean.iso_datetime(F.col("resolved_at")).alias("resolved"),
    )
    has_end = ~is_blank(F.col("resolved_at"))
    malformed = F.col("opened").isNull() | (has_end & F.col("resolved").isNull())
    hits = {
        **_key_hits("support_tickets"),
        "unknown_customer": ~F.col("customer_found"),
        "bad_timestamps": malformed,
        "resolved_early": has_end & (F.col("resolved") < F.col("opened")),
        "no_issue_category": is_blank(F.col("issue_category")),
        "unknown_priority": ~F.col("governed_priority").isin(*fixed.PRIORITIES),
        "alias_priority": _is_alias("priority", F.col("governed_priority"), fixed.PRIORITIES),
    }
    return with_mask("support_tickets", rows, hits).select(
        "ticket_id", "customer_id", "opened_at",
        clean.month(F.col("opened_at")).alias("opened_month"),
        clean.null_if_blank(F.col("resolved_at")).alias("resolved_at"),
        _upper("ticket_status").alias("ticket_status"),
        F.col("governed_priority").alias("priority"),
        _upper("issue_category").alias("issue_category"),
        F.when(has_end, clean.elapsed_hours(F.col("opened"), F.col("resolved"))).alias("resolution_hours"),
        F.when(~is_blank(F.col("satisfaction_score")), _score("satisfaction_score")).alias("satisfaction_score"),
        "customer_segment",
        MASK,
        ROW_ORDER, "copies", *DROPPED,
    )


def validate_finance(source: DataFrame, orders: DataFrame, *, repeated: DataFrame | None = None) -> DataFrame:
    """Judge ledger rows against validated orders in a single lookup.

    The lookup answers existence (quarantined orders still exist), the
    status-based expected amount, and whether the order reached the warehouse.
    """
    wide = F.col("order_amount_cents").isNull()
    judged = orders.withColumns({
        "order_loaded": ~has_any(flags_with("orders", action="QUARANTINE")),
        "expected_cents": expected_amount(F.col("order_status"), F.col("order_amount_cents")),
        "wide_amount": F.when(wide, F.col("source_amount")),
        "wide_status": F.when(wide, F.col("order_status")),
    })
    rows = lookup(
        _first_rows("finance_transactions", source, repeated), "order_id", "finance_transaction_id",
        judged, "order_id",
        {name: name for name in ("expected_cents", "wide_amount", "wide_status", "order_loaded")},
        "order_found", hot_keys(source, "order_id"),
    ).select(
        "*",
        clean.finance_type(F.col("transaction_type")).alias("governed_type"),
        clean.to_decimal(F.col("transaction_amount")).alias("amount"),
    ).withColumn("ledger_cents", clean.cents(F.col("amount")))
    ledger = F.col("ledger_cents")
    hits = {
        **_key_hits("finance_transactions"),
        "unknown_order": ~F.col("order_found"),
        "bad_posted_date": clean.iso_date(F.col("posted_date")).isNull(),
        "bad_amount": F.col("amount").isNull(),
        "unknown_type": ~F.col("governed_type").isin(*fixed.FINANCE_TYPES),
        "alias_type": _is_alias("transaction_type", F.col("governed_type"), fixed.FINANCE_TYPES),
        "bad_currency_or_posting": ~(
            F.coalesce(F.col("currency"), F.lit("")).isin(*fixed.CURRENCIES)
            & F.coalesce(F.col("posting_status"), F.lit("")).isin(*fixed.POSTING_STATUSES)
        ),
        "ledger_mismatch": F.col("order_found") & ledger_differs(),
    }
    rows = with_mask("finance_transactions", rows, hits, "own_mask")
    held = has_any(flags_with("finance_transactions", action="QUARANTINE"), "own_mask")
    cascade = ~held & ~F.coalesce(F.col("order_loaded"), F.lit(False))
    rows = with_mask("finance_transactions", rows, {CASCADE_RULE: cascade}, "cascade_mask")
    return rows.select(
        "finance_transaction_id", "order_id", "posted_date",
        clean.month(F.col("posted_date")).alias("posted_month"),
        F.col("governed_type").alias("transaction_type"),
        ledger.alias("transaction_amount_cents"),
        F.col("transaction_amount").alias("source_amount"),
        _upper("currency").alias("currency"),
        _upper("posting_status").alias("posting_status"),
        (F.col("own_mask") + F.col("cascade_mask")).alias(MASK),
        ROW_ORDER, "copies", *DROPPED,
    )


def expected_amount(status: Column, amount: Column) -> Column:
    """Ledger amount an order calls for, by its governed status."""
    return (
        F.when(amount.isNull(), None)
        .when(status.isin(*fixed.FULFILLED), amount)
        .when(status == "RETURNED", -F.abs(amount))
        .otherwise(F.lit(0).cast("bigint"))
    )


def ledger_differs() -> Column:
    """Whether a readable ledger amount is not what its readable order calls for.

    Cents answer it. An amount too wide for them is readable all the same: then both
    amounts are compared as decimals, and as doubles where both exceed decimals too.
    Text and status of an order come along only where it has no cents.
    """
    status, expected = F.col("wide_status"), F.col("expected_cents")
    has_cents = F.col("ledger_cents").isNotNull() & expected.isNotNull()
    in_cents = (expected.cast("decimal(20,0)") / F.lit(100)).cast("decimal(38,18)")
    calls_for = F.coalesce(in_cents, expected_amount(status, clean.to_decimal(F.col("wide_amount"))))
    beyond = clean.is_beyond(F.col("amount")) & clean.is_beyond(calls_for)
    wide = (F.round("amount", 2) != F.round(calls_for, 2)) | (
        beyond & (F.col("transaction_amount").try_cast("double") != expected_amount(status, F.col("wide_amount").try_cast("double")))
    )
    return F.when(has_cents, F.col("ledger_cents") != expected).otherwise(wide)
