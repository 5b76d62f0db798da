import datetime

import pytest
from pyspark.sql import functions as F

from cleargrain.functions import clean
from cleargrain.functions.measure import growth, half_up, percent, title_text

CASES = [
    # builder, text, expected
    ("cents", "10.235", 1024), ("cents", "-10.235", -1024), ("cents", "1e3", 100000),
    ("cents", " 5 ", 500), ("cents", "1_000.10", 100010), ("cents", "NaN", None),
    ("cents", "abc", None), ("cents", "", None), ("cents", None, None),
    ("points", "0.125", 1250), ("points", "0.00005", 1), ("points", "0.0500", 500),
    ("segment", "small business", "SMB"), ("segment", "Mid Market", "MID_MARKET"),
    ("segment", "enterprise ", "ENTERPRISE"), ("segment", "\tsmb ", "SMB"),
    ("segment", "other thing", "OTHER_THING"), ("segment", None, ""),
    ("category", "Professional Services", "SERVICES"), ("category", "Cybersecurity", "SECURITY"),
    ("category", "Cloud  Services", "CLOUD"), ("category", "data-analytics", "DATA"),
    ("status", "canceled", "CANCELLED"), ("status", "Return", "RETURNED"),
    ("status", "complete", "COMPLETED"), ("status", "shipped ", "SHIPPED"),
    ("priority", "-high-", "HIGH"), ("priority", "high-priority", "HIGH"),
    ("priority", "Med", "MEDIUM"), ("priority", "urgent", "CRITICAL"),
    ("finance", "Credit", "REFUND"), ("finance", "sale ", "SALE"),
    ("date", "2025-01-05", datetime.date(2025, 1, 5)), ("date", "2024-02-29", datetime.date(2024, 2, 29)),
    ("date", "2025-02-29", None), ("date", "2025-13-40", None), ("date", "2025-1-5", None),
    ("date", "2025", None), ("date", "20250105", datetime.date(2025, 1, 5)), ("date", "2025-W02-3", datetime.date(2025, 1, 8)), ("date", "2025W02", datetime.date(2025, 1, 6)), ("date", "2025-W53", None), ("date", "20251305", None), ("date", "2025-01-05T10:00", None),
    ("date", "0000-01-01", None), ("date", "not-a-date", None), ("date", "", None), ("date", None, None),
    ("time", "2025-01-01T10:00", datetime.datetime(2025, 1, 1, 10)),
    ("time", "2025-01-01 10:00:30", datetime.datetime(2025, 1, 1, 10, 0, 30)),
    ("time", "2025-01-01T10", datetime.datetime(2025, 1, 1, 10)),
    ("time", "2025-01-01T10:00:00,5", datetime.datetime(2025, 1, 1, 10, 0, 0, 500000)),
    ("time", "2025-01-01", datetime.datetime(2025, 1, 1)),
    ("time", "2025-01-01T25:00", None), ("time", "2025-01-01T10:00+01:00", datetime.datetime(2025, 1, 1, 9)), ("time", "2025-01-01T23:30:15.25-0200", datetime.datetime(2025, 1, 2, 1, 30, 15, 250000)), ("time", "20250101T1000Z", datetime.datetime(2025, 1, 1, 10)), ("time", "2025-01-01T10:00+24:00", None),
    ("time", "not-a-date", None), ("time", "", None),
    ("strip", "  a b\n", "a b"), ("title", "INVALID_CUSTOMER_REFERENCE", "Invalid Customer Reference"),
]
BUILDERS = {
    "cents": lambda c: clean.cents(clean.to_decimal(c)),
    "points": lambda c: clean.basis_points(clean.to_decimal(c)),
    "segment": clean.customer_segment, "category": clean.product_category, "status": clean.order_status,
    "priority": clean.priority, "finance": clean.finance_type, "date": clean.iso_date,
    "time": clean.iso_datetime, "strip": clean.strip, "title": title_text,
}


@pytest.fixture(scope="module")
def results(spark):
    frame = spark.createDataFrame([(n, text) for n, (_, text, _) in enumerate(CASES)], "n int, text string")
    columns = [build(F.col("text")).alias(name) for name, build in BUILDERS.items()]
    return {row.n: row for row in frame.select("n", *columns).collect()}


@pytest.mark.parametrize("n", range(len(CASES)), ids=[f"{b}:{t!r}" for b, t, _ in CASES])
def test_text(results, n):
    builder, _, expected = CASES[n]
    assert results[n][builder] == expected


def test_exact_arithmetic(spark):
    frame = spark.createDataFrame(
        [(1, 8), (5, 2), (-5, 2), (7, 0), (10**17, 3), (2, 3)], "a bigint, b bigint"
    )
    got = frame.select(
        half_up(F.col("a"), F.col("b")).alias("h"), percent(F.col("a"), F.col("b")).alias("p"),
    ).collect()
    assert [row.h for row in got] == [0, 3, -3, None, 33333333333333333, 1]
    assert [row.p for row in got[:4]] == [12.5, 250.0, -250.0, None]
    change = spark.createDataFrame([(50, -100), (5, 0), (3, None)], "a bigint, b bigint")
    assert [r.g for r in change.select(growth(F.col("a"), F.col("b")).alias("g")).collect()] == [150.0, None, None]
