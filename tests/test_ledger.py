"""Ledger rows against orders whose amounts are unreadable, or too wide for 64-bit cents."""

import os

import duckdb
import pytest

from cleargrain.functions import fixed
from cleargrain.operators import rules
from cleargrain.oracle import sql
from cleargrain.plans.staging import Staging

WIDE, WIDER = "123456789012345678.90", "4" * 30

# order amount, order status, ledger amount, whether the amounts differ
CASES = [
    ("n/a", "CANCELLED", "0.00", False), ("n/a", "CANCELLED", "12.00", False), ("n/a", "COMPLETED", "12.00", False),
    ("", "RETURNED", "-5", False), ("10", "CANCELLED", "12.00", True), ("10", "COMPLETED", "n/a", False),
    (WIDE, "COMPLETED", WIDE, False), (WIDE, "COMPLETED", "1.00", True), (WIDE, "RETURNED", f"-{WIDE}", False),
    (WIDE, "RETURNED", WIDE, True), (WIDE, "CANCELLED", "0", False), (WIDE, "CANCELLED", WIDE, True),
    (WIDE, "SHIPPED", "123456789012345678.91", True), ("1", "SHIPPED", WIDER, True), (WIDER, "SHIPPED", WIDER, False),
    (WIDER, "SHIPPED", "5" * 30, True), (WIDER, "RETURNED", f"-{WIDER}", False), (WIDER, "CANCELLED", "0.004", False),
]


def test_readable_amounts_are_compared_whatever_their_size(spark, make_sources, folder):
    orders = [{"order_id": f"B-{n}", "order_amount": case[0], "order_status": case[1]} for n, case in enumerate(CASES)]
    ledger = [{"finance_transaction_id": f"L-{n:04d}", "order_id": f"B-{n}", "transaction_amount": case[2]} for n, case in enumerate(CASES)]
    staging = Staging(spark, make_sources(orders=orders, finance_transactions=ledger), folder)
    differ, unreadable = (rules.hit_sql(rules.flags_with("finance_transactions", name=name)) for name in ("ledger_mismatch", "bad_amount"))
    found = staging.validated("finance_transactions").orderBy("finance_transaction_id").selectExpr(differ, unreadable).collect()
    assert [tuple(r) for r in found] == [(case[3], case[2] == "n/a") for case in CASES]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not here")
def test_sql_expects_nothing_of_an_unreadable_order():
    """The judged ledger of the SQL side, over an order without a readable amount that was cancelled."""
    engine = duckdb.connect()
    engine.execute("CREATE TABLE judged_orders AS SELECT 'B-1' AS order_id, 'n/a' AS order_amount, 'CANCELLED' AS status")
    columns = ", ".join(f"'L-1' AS {c}" if c == fixed.KEYS["finance_transactions"] else f"'B-1' AS {c}" if c == "order_id" else f"'12.00' AS {c}" for c in fixed.RAW_COLUMNS["finance_transactions"])
    engine.execute(f"CREATE TABLE uniq_finance_transactions AS SELECT {columns}")
    hit = sql.HITS["finance_transactions"]["ledger_mismatch"]
    answer = engine.execute(f"SELECT coalesce({hit}, false) FROM ({sql.CTES['judged_finance_transactions']})").fetchall()
    assert answer == [(False,)]
