"""The same answers when single keys hold a third of the rows."""

import os
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

from cleargrain.operators import records
from cleargrain.oracle.sql import oracles
from cleargrain.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
NAMES = (
    "dedup_first", "dq_invalid_fk", "dq_exceptions", "profile_tables", "profile_columns", "wh_fact_order",
    "wh_fact_finance", "quarantine_finance", "recon_controls", "category_performance", "dashboard_dataset",
    "segment_metrics", "top_customers", "finance_variance", "reference_audit",
)
# Orders repeat one order, or belong to one customer; events to an unknown one; lines to one order.
CHANGED = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 42 ELSE o_orderkey END AS o_orderkey,"
              " CASE WHEN o_orderkey % 3 = 1 THEN 7 ELSE o_custkey END AS o_custkey)",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 999999 ELSE user_id END AS user_id)",
    "lineitem": "SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey)",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    connection = duckdb.connect()
    for file in os.listdir(SF):
        table = file.removesuffix(".parquet")
        if table in CHANGED:
            connection.execute(f"COPY ({CHANGED[table]} FROM '{SF}/{file}') TO '{folder}/{file}'")
        else:
            shutil.copy(f"{SF}/{file}", f"{folder}/{file}")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{file}'")
    return folder, connection


@pytest.mark.parametrize("name", NAMES)
def test_skewed(spark, skewed, name):
    folder, connection = skewed
    answer = connection.execute(oracles()[name])
    names = [column[0] for column in answer.description]
    expected = answer.fetchall()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = [tuple(row) for row in QUERIES[name](spark, folder).select(*names).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_a_hot_foreign_key_does_not_gather(spark):
    """A third of the rows under one key, another third under none: partitions stay even."""
    rows = spark.range(30_000).selectExpr(
        "cast(id as string) AS record", "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN '' ELSE cast(id as string) END AS key")
    parents = spark.range(30_000).selectExpr("cast(id as string) AS key", "'x' AS kind").unionAll(spark.sql("SELECT 'hot', 'y'"))
    settings = {"spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = records.lookup(rows, "key", "record", parents, "key", {"kind": "kind"}, "found", records.hot_keys(rows, "key"))
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        kept = records.keep_first(rows, ["key"], ["record"])
        assert kept.where("copies > 1").count() == 2 and kept.count() == 10_002
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert sum(sizes) == 30_000 and max(sizes) < 2 * 30_000 / 20
