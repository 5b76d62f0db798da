from collections import Counter

from pyspark.sql import functions as F

from cleargrain.operators import records
from cleargrain.operators.numbering import number, place
from cleargrain.plans.storage import write_then_read


def test_duplicates_list_each_key_once(spark, rows):
    frame = spark.createDataFrame([("A",), ("A",), ("B",), ("",), ("",), (None,)], "id string")
    assert rows(records.find_duplicates(frame, "id")) == [("A", 2)]


def test_missing_required_names_the_fields(spark, rows):
    frame = spark.createDataFrame([("A", ""), ("B", "Present"), ("C", None)], "id string, name string")
    assert rows(records.missing_required(frame, ("id", "name"), "id")) == [("A", ["name"]), ("C", ["name"])]


def test_invalid_references_ignore_blank(spark, rows):
    child = spark.createDataFrame([("1", "K-201"), ("2", "BAD"), ("3", ""), ("4", None)], "id string, ref string")
    parent = spark.createDataFrame([("K-201",), ("K-201",)], "id string")
    assert rows(records.invalid_references(child, "ref", parent, "id", "id")) == [("2", "BAD")]


def test_keep_first_by_order_and_one_blank_key(spark, rows):
    frame = spark.createDataFrame(
        [("A", "late", 2), ("A", "early", 1), ("B", "only", 3), ("", "x", 5), (None, "y", 4)],
        "id string, v string, n int",
    )
    kept = records.keep_first(frame.repartition(4), ["id"], ["n"])
    assert rows(kept, "v", "copies") == [("early", 2), ("only", 1), ("y", 2)]


def test_lookup_with_hot_and_blank_keys(spark):
    """A key and the blank value each hold a third of the rows."""
    keys = [["HOT", "", f"K{n % 50}"][n % 3] for n in range(900)] + ["GONE"] * 400
    facts = spark.createDataFrame([(f"r{n}", key) for n, key in enumerate(keys)], "id string, ref string")
    parents = spark.createDataFrame(
        [("HOT", "hot value"), ("", "never")] + [(f"K{n}", f"v{n}") for n in range(40)], "key string, value string"
    )
    hot = records.hot_keys(facts, "ref")
    assert {"HOT", "GONE"} <= {row.hot_key for row in hot.collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = records.lookup(facts, "ref", "id", parents, "key", {"value": "value"}, "found", hot)
        got = {row.id: (row.ref, row.value, row.found) for row in joined.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    values = {"HOT": "hot value", **{f"K{n}": f"v{n}" for n in range(40)}}
    assert got == {f"r{n}": (key, values.get(key), key in values) for n, key in enumerate(keys)}


def test_numbering_equals_a_full_sort(spark, folder):
    data = [(n % 3, (n * 7919) % 1000, f"x{n}") for n in range(1000)]
    frame = spark.createDataFrame(data, "section int, at int, name string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = write_then_read(place(frame, ["section", "at", "name"]), f"{folder}/placed")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    numbered = number(placed, ["section"], "no")
    got = [row.name for row in numbered.orderBy("no").collect()]
    assert got == [name for _, _, name in sorted(data)]
    assert Counter(row.no for row in numbered.collect()) == Counter(range(1, 1001))
    assert placed.select(F.countDistinct("part")).first()[0] > 1
