"""Rows stay where they are unless their key may repeat."""

import pytest

from cleargrain.functions import fixed
from cleargrain.operators import audit, profile, records
from cleargrain.plans import storage, warehouse
from cleargrain.plans.staging import Staging
from cleargrain.plans.warehouse import StagedWarehouse, reconciliation


@pytest.fixture
def shuffled(spark):
    """No table is broadcast for being small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _frame(spark):
    return spark.sql(
        "SELECT CASE WHEN id < 4 THEN 'A' WHEN id = 4 THEN NULL WHEN id = 5 THEN '' ELSE concat('K', id) END AS id, 9 - id AS n, 'x' AS more"
        " FROM range(10)"
    )


def test_keep_first_joins_no_whole_rows(spark, shuffled, rows):
    kept = records.keep_first(_frame(spark), ["id"], ["n"])
    assert "SortMergeJoin" not in shuffled(kept)
    expected = [("A", 6, 4), ("K6", 3, 1), ("K7", 2, 1), ("K8", 1, 1), ("K9", 0, 1)]
    assert rows(kept.where("id <> ''"), "id", "n", "copies") == expected
    assert [(r["n"], r["copies"]) for r in kept.where("coalesce(id, '') = ''").collect()] == [(4, 2)]


def test_more_hashes_than_are_broadcast(spark, shuffled, rows, monkeypatch):
    few = records.keep_first(_frame(spark), ["id"], ["n"]).selectExpr("coalesce(id, '') AS id", "n", "copies")
    monkeypatch.setattr(records, "_MOST_HASHES", 0)
    many = records.keep_first(_frame(spark), ["id"], ["n"])
    assert "SortMergeJoin" in shuffled(many)
    assert rows(many.selectExpr("coalesce(id, '') AS id", "n", "copies")) == rows(few)
    assert rows(records.find_duplicates(_frame(spark), "id")) == [("A", 4)]


def test_keys_that_are_equal_have_one_hash(spark):
    frame = spark.sql("SELECT * FROM VALUES (0.0D, 1, 1), (-0.0D, 1, 2), (double('NaN'), 1, 3), (double('NaN'), 1, 4), (1.0D, NULL, 5), (1.0D, NULL, 6) AS t(a, b, n)")
    kept = records.keep_first(frame, ["a", "b"], ["n"])
    assert sorted((r["n"], r["copies"]) for r in kept.collect()) == [(1, 2), (3, 2), (5, 2)]


def test_audited_keys_travel_as_hashes(spark, shuffled):
    keys = spark.range(20).selectExpr("concat('C', id % 19) AS customer_id")
    audited = audit.key_audit({"dim_customer": keys})
    assert "_hash" in shuffled(audited) and [r["repeated_keys"] for r in audited.collect()] == [1]


def test_repeated_rows_are_found_without_moving_all(spark, shuffled, make_sources):
    sources = make_sources(orders=[{}, {}, {"order_id": "B-902"}])
    told = profile.profile_tables(sources)
    assert "SortMergeJoin" not in shuffled(told)
    row = told.where("dataset = 'orders'").first()
    assert (row["row_count"], row["duplicate_row_count"], row["duplicate_primary_key_count"]) == (3, 1, 1)


def test_hashes_travel_as_arrays(spark, shuffled):
    told = spark.range(60).selectExpr("concat('K', id % 59) AS id").withColumn("_hash", records.key_hash("id"))
    found = records.times_counted(told, "_hash")
    plan = shuffled(found)
    assert "hashpartitioning(_hash" not in plan and "collect_list" in plan
    zero = told.where("id = 'K0'").first()["_hash"]
    assert [row["_hash"] for row in found.collect()] == [zero]


def test_a_hot_hash_meets_in_no_array(spark, monkeypatch):
    monkeypatch.setattr(records, "_HASH_BITS", 32)  # all in one array
    told = spark.range(9_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id < 5 THEN 'two' ELSE concat('K', id) END AS id")
    told = told.withColumn("_hash", records.key_hash("id"))
    seen = []
    plain = records.F.collect_list
    monkeypatch.setattr(records.F, "collect_list", lambda column: seen.append(column) or plain(column))
    names = {row["_hash"]: row["id"] for row in told.distinct().collect()}
    found = records.times_counted(told, "_hash")
    assert seen and sorted(names[row["_hash"]] for row in found.collect()) == ["hot", "two"]
    arrays = found._jdf.queryExecution().optimizedPlan().toString()
    hot = next(h for h, name in names.items() if name == "hot")
    assert f"{hot}" in arrays


def test_rows_carry_their_lookup_key_once(spark, shuffled):
    facts = spark.sql("SELECT concat('R', id) AS record, CASE id WHEN 1 THEN NULL WHEN 2 THEN '' ELSE concat('K', id) END AS ref FROM range(9)")
    parents = spark.sql("SELECT concat('K', id) AS key, id AS v FROM range(6)")
    hot = spark.sql("SELECT 'K3' AS hot_key")
    joined = records.lookup(facts, "ref", "record", parents, "key", {"v": "v"}, "found", hot)
    sent = next(line for line in joined._jdf.queryExecution().optimizedPlan().toString().splitlines() if "AS _lookup" in line)
    assert not any(item.startswith("ref#") for item in sent.split("Project [")[1].split(", "))
    got = [(r["record"], r["ref"], r["v"], r["found"]) for r in joined.orderBy("record").collect()]
    refs = [None if n == 1 else "" if n == 2 else f"K{n}" for n in range(9)]
    assert got == [(f"R{n}", ref, n if ref and n < 6 else None, bool(ref) and n < 6) for n, ref in enumerate(refs)]


def test_reconciliation_counts_no_hashes_again(spark, make_sources, monkeypatch):
    staging = Staging(spark, make_sources(orders=[{}, {}, {"order_id": "B-902"}]))
    staging.prepare(*fixed.DATASETS)
    counted = []
    plain = records.times_counted
    monkeypatch.setattr(records, "times_counted", lambda frame, column: counted.append(frame) or plain(frame, column))
    told = reconciliation(staging, StagedWarehouse(staging)).where("control_name = 'orders_count'").first()
    assert (told["source_value"], told["target_value"], counted) == (2, 2, [])


def test_written_tables_are_packed(spark, tmp_path):
    storage.Shelf(str(tmp_path)).get("kept", lambda: spark.range(3))
    warehouse._write_table("dim_customer", spark.range(3), str(tmp_path / "published"))
    assert {path.name.split(".")[-2] for path in tmp_path.glob("*/part-*")} == {"zstd"}
