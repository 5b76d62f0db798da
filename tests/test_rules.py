"""One hit and one near miss per rule, all judged in a single run."""

import pytest

from cleargrain.functions import fixed
from cleargrain.operators import rules
from cleargrain.plans.staging import Staging

# dataset, rule, change that hits, change that must not hit
CASES = [
    ("customers", "no_customer_name", {"customer_name": ""}, {"customer_name": " "}),
    ("customers", "no_customer_segment", {"customer_segment": None}, {}),
    ("customers", "no_created_date", {"created_date": ""}, {}),
    ("customers", "no_crm_status", {"crm_status": ""}, {}),
    ("customers", "bad_created_date", {"created_date": "2025-1-5"}, {"created_date": ""}),
    ("customers", "unknown_segment", {"customer_segment": "Retail"}, {"customer_segment": "small-business"}),
    ("customers", "alias_segment", {"customer_segment": "small business"}, {"customer_segment": "Retail"}),
    ("customers", "no_region", {"region": ""}, {"region": "  "}),
    ("products", "no_product_name", {"product_name": ""}, {}),
    ("products", "no_product_category", {"product_category": ""}, {}),
    ("products", "no_unit_price", {"unit_price": ""}, {"unit_price": "x"}),
    ("products", "no_unit_cost", {"unit_cost": ""}, {}),
    ("products", "no_active_flag", {"active_flag": ""}, {}),
    ("products", "unknown_category", {"product_category": "Toys"}, {"product_category": "cloud"}),
    ("products", "alias_category", {"product_category": "Cybersecurity"}, {}),
    ("products", "bad_price", {"unit_cost": "64.51"}, {"unit_cost": "64.50"}),
    ("products", "bad_price", {"unit_price": "0"}, {"unit_cost": "0"}),
    ("products", "bad_price", {"unit_price": "NaN"}, {}),
    ("products", "unusual_price", {"unit_price": "20000.01"}, {"unit_price": "20000.00"}),
    ("orders", "no_customer", {"customer_id": ""}, {"customer_id": "NOBODY"}),
    ("orders", "unknown_customer", {"customer_id": "NOBODY"}, {"customer_id": ""}),
    ("orders", "unknown_product", {"product_id": "NOTHING"}, {}),
    ("orders", "unknown_product", {"product_id": ""}, {}),
    ("orders", "bad_order_date", {"order_date": "2025-13-40"}, {"order_date": "2024-02-29"}),
    ("orders", "bad_order_date", {"order_date": ""}, {}),
    ("orders", "bad_quantity", {"quantity": "0"}, {"quantity": "2.0"}),
    ("orders", "bad_quantity", {"quantity": "1.5"}, {"quantity": "1"}),
    ("orders", "bad_amount", {"order_amount": "-0.01"}, {"order_amount": "0"}),
    ("orders", "bad_amount", {"order_amount": "NaN"}, {}),
    ("orders", "bad_price_or_discount", {"discount_rate": "1.01"}, {"discount_rate": "1"}),
    ("orders", "bad_price_or_discount", {"unit_price": "0"}, {"discount_rate": "0"}),
    ("orders", "unusual_amount", {"order_amount": "100000.01"}, {"order_amount": "100000"}),
    ("orders", "unknown_status", {"order_status": "ON_HOLD"}, {"order_status": "canceled"}),
    ("orders", "alias_status", {"order_status": "canceled"}, {"order_status": "ON_HOLD"}),
    ("support_tickets", "unknown_customer", {"customer_id": "NOBODY"}, {}),
    ("support_tickets", "unknown_customer", {"customer_id": ""}, {}),
    ("support_tickets", "bad_timestamps", {"opened_at": "not-a-date"}, {"resolved_at": ""}),
    ("support_tickets", "bad_timestamps", {"resolved_at": "tomorrow"}, {}),
    ("support_tickets", "resolved_early", {"resolved_at": "2024-06-10T09:14"}, {"resolved_at": "2024-06-10T09:15"}),
    ("support_tickets", "no_issue_category", {"issue_category": ""}, {}),
    ("support_tickets", "unknown_priority", {"priority": "G-39"}, {"priority": "Med"}),
    ("support_tickets", "alias_priority", {"priority": "urgent"}, {"priority": "G-39"}),
    ("finance_transactions", "unknown_order", {"order_id": "NONE"}, {}),
    ("finance_transactions", "bad_posted_date", {"posted_date": "31/31/2025"}, {}),
    ("finance_transactions", "bad_amount", {"transaction_amount": "x"}, {"transaction_amount": "1e2"}),
    ("finance_transactions", "unknown_type", {"transaction_type": "TRANSFER"}, {"transaction_type": "Credit"}),
    ("finance_transactions", "alias_type", {"transaction_type": "Credit"}, {"transaction_type": "TRANSFER"}),
    ("finance_transactions", "bad_currency_or_posting", {"currency": "usd"}, {"posting_status": "PENDING"}),
    ("finance_transactions", "bad_currency_or_posting", {"posting_status": "OPEN"}, {}),
    ("finance_transactions", "ledger_mismatch", {"transaction_amount": "154.81"}, {"transaction_amount": "154.795"}),
    ("finance_transactions", "ledger_mismatch", {"order_id": "RETURNED", "transaction_amount": "154.8"},
     {"order_id": "RETURNED", "transaction_amount": "-154.8"}),
    ("finance_transactions", "ledger_mismatch", {"order_id": "CANCELLED"},
     {"order_id": "CANCELLED", "transaction_amount": "0"}),
    ("finance_transactions", "order_not_loaded", {"order_id": "HELD"}, {"order_id": "HELD", "currency": "EUR"}),
]


@pytest.fixture(scope="module")
def masks(spark, make_sources):
    changes = {dataset: [{}] for dataset in fixed.DATASETS}
    changes["orders"] += [
        {"order_id": "RETURNED", "order_status": "RETURNED"},
        {"order_id": "CANCELLED", "order_status": "CANCELLED"},
        {"order_id": "HELD", "quantity": "0"},
    ]
    for n, (dataset, _, hit, miss) in enumerate(CASES):
        key = fixed.KEYS[dataset]
        changes[dataset] += [{**hit, key: f"hit{n}"}, {**miss, key: f"miss{n}"}]
    for dataset in fixed.DATASETS:
        key = fixed.KEYS[dataset]
        changes[dataset] += [{key: "twice"}, {key: "twice"}, {key: ""}, {key: None}]
    staging = Staging(spark, make_sources(**changes))
    found = {}
    for dataset in fixed.DATASETS:
        for row in staging.validated(dataset).collect():
            found[dataset, row[fixed.KEYS[dataset]]] = {
                rule.name for rule in rules.CATALOGUE[dataset] if row.issue_mask & rule.flag
            }
    return found


@pytest.mark.parametrize("n", range(len(CASES)), ids=[f"{c[0]}-{c[1]}-{n}" for n, c in enumerate(CASES)])
def test_rule(masks, n):
    dataset, rule, _, _ = CASES[n]
    assert rule in masks[dataset, f"hit{n}"]
    assert rule not in masks[dataset, f"miss{n}"]


@pytest.mark.parametrize("dataset", fixed.DATASETS)
def test_sound_repeated_and_missing_keys(masks, dataset):
    assert masks[dataset, fixed_key(dataset)] == set()
    assert masks[dataset, "twice"] == {"repeated_key"}
    blank = [found for (name, key), found in masks.items() if name == dataset and not key]
    assert len(blank) == 1 and "missing_key" in blank[0] and "repeated_key" not in blank[0]


def fixed_key(dataset):
    return {"customers": "K-201", "products": "G-31", "orders": "B-901", "support_tickets": "H-51",
            "finance_transactions": "L-7001"}[dataset]


def test_every_rule_has_a_case():
    covered = {(dataset, rule) for dataset, rule, _, _ in CASES}
    assert covered == {
        (dataset, rule.name) for dataset in fixed.DATASETS for rule in rules.CATALOGUE[dataset]
        if rule.name not in rules.KEY_RULES
    }
