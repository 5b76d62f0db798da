"""Counts taken while staging is written, and records that are lost, doubled or swapped."""

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from cleargrain.functions import fixed
from cleargrain.operators import rules
from cleargrain.plans.staging import Staging
from cleargrain.plans.warehouse import StagedWarehouse


@pytest.fixture(scope="module")
def staging(spark, make_sources, tmp_path_factory):
    changes = {
        "orders": [{}, {}, {"order_id": "B-902", "order_amount": "20.00"}, {"order_id": "B-903", "order_amount": "n/a"},
                   {"order_id": "B-904", "order_amount": "20.00", "customer_id": "NOBODY"}, {"order_id": ""}, {"order_id": None}, {"order_id": "B-902", "order_amount": "21"}],
        "finance_transactions": [{}, {"finance_transaction_id": "L-2", "transaction_amount": "7.5"}, {"finance_transaction_id": "L-2", "transaction_amount": "8.5"}],
        "support_tickets": [{}, {"ticket_id": "H-52", "priority": "none"}, {"ticket_id": "H-52"}],
    }
    return Staging(spark, make_sources(**changes), str(tmp_path_factory.mktemp("staging")))


def scanned(frame):
    return "FileScan" in frame._jdf.queryExecution().executedPlan().toString()


def test_counts_are_those_of_the_written_tables_and_read_nothing(staging):
    for dataset in fixed.DATASETS:
        table, counts = staging.validated(dataset), staging.written(dataset)
        held = rules.has_any(rules.flags_with(dataset, action="QUARANTINE"))
        assert counts["unique_rows"] == table.count() and counts["quarantined_rows"] == table.where(held).count()
        assert counts["source_rows"] == staging.sources[dataset].count()
        for rule in rules.CATALOGUE[dataset]:
            assert counts[f"hits_{rule.bit}"] == table.where(rules.hit_sql(rule.flag)).count()
    assert not scanned(staging.controls()) and not scanned(staging.counts()) and not scanned(staging.issue_counts())


def test_records_are_conserved(staging):
    found = staging.conservation(StagedWarehouse(staging).tables).collect()
    assert [(r.control_name, r.source_rows, r.target_rows, r.status) for r in found] == [
        ("orders_rows", 8, 8, "PASS"), ("support_tickets_rows", 3, 3, "PASS"), ("finance_transactions_rows", 3, 3, "PASS"),
    ]


def changed(staging, name, change):
    tables = dict(StagedWarehouse(staging).tables)
    tables[name] = change(tables[name])
    return {r.dataset: r.status for r in staging.conservation(tables).collect()}


@pytest.mark.parametrize("what", ["swap", "lose", "double", "cents", "key"])
def test_single_records_count(staging, what):
    """Two swapped amounts keep the count and the cents of every side."""
    other = F.when(F.col("order_id") == "B-901", 2000).when(F.col("order_id") == "B-902", 15480).cast("bigint")
    changes = {
        "swap": lambda t: t.withColumn("order_amount_cents", F.coalesce(other, "order_amount_cents")),
        "lose": lambda t: t.where("order_id <> 'B-902'"),
        "double": lambda t: t.unionByName(t.where("order_id = 'B-902'")),
        "cents": lambda t: t.withColumn("order_amount_cents", F.col("order_amount_cents") + 1),
        "key": lambda t: t.withColumn("order_id", F.concat("order_id", F.lit("x"))),
    }
    assert changed(staging, "fact_order", changes[what]) == {"orders": "FAIL", "support_tickets": "PASS", "finance_transactions": "PASS"}


def test_the_source_side_is_one_narrow_scan(staging):
    """No first rows are looked for again: nothing but sums is shuffled."""
    plan = staging.conservation(StagedWarehouse(staging).tables)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning" not in plan


RETRIED = """
from pyspark import TaskContext
from pyspark.sql import Observation, SparkSession, functions as F
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", False).config("spark.sql.shuffle.partitions", 3).getOrCreate()
@F.udf("long")
def shaky(x):
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
        raise RuntimeError("lost")
    return x
seen = Observation()
rows = spark.range(0, 1000, 1, 4).repartition(3, "id").withColumn("x", shaky("id")).observe(seen, F.count("x").alias("n"), F.sum("x").alias("s"))
rows.write.parquet(__import__("sys").argv[1])
assert seen.get == {"n": 1000, "s": 499500}, seen.get
print("counted once")
"""


def test_a_retried_task_counts_once(folder):
    done = subprocess.run([sys.executable, "-c", RETRIED, f"{folder}/out"], capture_output=True, text=True, timeout=300)
    assert "counted once" in done.stdout, done.stderr[-2000:]
