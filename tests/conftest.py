import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cleargrain.functions import fixed  # noqa: E402
from cleargrain.session import local_session  # noqa: E402

# One sound record per source; tests change single fields of it.
GOOD = {
    "customers": {
        "customer_id": "K-201", "customer_name": "Harbor Lane Bakery", "customer_segment": "ENTERPRISE",
        "region": "WEST", "created_date": "2023-11-20", "crm_status": "INACTIVE",
    },
    "products": {
        "product_id": "G-31", "product_name": "Ledger Sync", "product_category": "DATA",
        "unit_price": "64.50", "unit_cost": "21.25", "active_flag": "N",
    },
    "orders": {
        "order_id": "B-901", "customer_id": "K-201", "product_id": "G-31", "order_date": "2024-06-07",
        "quantity": "3", "unit_price": "64.50", "discount_rate": "0.20", "order_amount": "154.80",
        "order_status": "SHIPPED", "channel": "PARTNER",
    },
    "support_tickets": {
        "ticket_id": "H-51", "customer_id": "K-201", "opened_at": "2024-06-10T09:15",
        "resolved_at": "2024-06-10T12:45", "ticket_status": "CLOSED", "priority": "MEDIUM",
        "issue_category": "BILLING", "satisfaction_score": "4",
    },
    "finance_transactions": {
        "finance_transaction_id": "L-7001", "order_id": "B-901", "posted_date": "2024-06-09",
        "transaction_type": "SALE", "transaction_amount": "154.80", "currency": "USD",
        "posting_status": "POSTED",
    },
}


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_sources(spark):
    """Five raw sources from row changes: ``orders=[{}, {"quantity": "0"}]``."""

    def make(**changes):
        sources = {}
        for dataset in fixed.DATASETS:
            rows = [{**GOOD[dataset], **change} for change in changes.get(dataset, [{}])]
            columns = fixed.RAW_COLUMNS[dataset]
            schema = ", ".join([*(f"{column} string" for column in columns), "line bigint"])
            data = [(*(row[column] for column in columns), n) for n, row in enumerate(rows)]
            sources[dataset] = spark.createDataFrame(data, schema).select(
                *columns, F.struct("line").alias("row_order")
            )
        return sources

    return make


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="cleargrain-test-")


@pytest.fixture(scope="session")
def rows():
    """Sorted tuples of a frame, in the given column order."""

    def collect(frame, *columns):
        return sorted(tuple(row) for row in frame.select(*(columns or frame.columns)).collect())

    return collect
