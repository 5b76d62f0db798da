import random

from brute import LOWER, components, repeats
from pyspark.sql import functions as F

from cleargrain.llm import exact_dedup, jaccard
from cleargrain.llm import repeats as suffixes
from cleargrain.llm.common import HOT_KEY_SHARE, join_facts


def as_rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def test_rows_of_a_hot_key_stay_where_they_are(spark):
    total = 6000
    rows = spark.range(0, total, 1, 12).selectExpr("id", "IF(id % 3 = 0, -1, id DIV 4) AS key")
    facts = rows.groupBy("key").agg(F.count("*").alias("size"), F.max("id").alias("last"))
    assert facts.where(F.col("size") > total * HOT_KEY_SHARE).count() == 1
    joined = join_facts(rows, facts, ["key"], "size", total)
    assert as_rows(joined, "id", "key", "size", "last") == as_rows(rows.join(facts, "key"), "id", "key", "size", "last")
    places = joined.where("key = -1").groupBy(F.spark_partition_id()).count().collect()
    assert len(places) == 12 and max(p["count"] for p in places) < total / 30


def test_key_without_facts_is_left_out(spark):
    rows = spark.createDataFrame([(1, 7), (2, 8), (3, 7)], "id long, key long")
    facts = spark.createDataFrame([(7, 2)], "key long, size long")
    for total in (3, 10**6):  # a hot key, and no hot key
        assert as_rows(join_facts(rows, facts, ["key"], "size", total), "id", "size") == [(1, 2), (3, 2)]
    assert join_facts(rows.limit(0), facts, ["key"], "size", 0).count() == 0


def test_exact_groups_with_a_third_of_the_rows_in_one(make_docs):
    rows = [(i, "Same Text" if i % 6 == 0 else "sAME tEXT" if i % 3 == 0 else f"text {i // 2}") for i in range(3000)]
    rows += [(None, None), (None, ""), (5, None), (0, "same text")]
    groups = {}
    for doc, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc)
    wanted = []
    for doc, text in rows:
        own = groups[(text or "").translate(LOWER)]
        keep = max((x for x in own if x is not None), default=None)
        wanted.append((doc, keep, len(own), doc == keep))
    found = exact_dedup.group_copies(make_docs(rows))
    assert as_rows(found, "id", "keep_id", "group_size", "kept") == sorted(wanted, key=repr)
    assert exact_dedup.drop_duplicates(make_docs(rows)).count() == len(groups)


def test_jaccard_with_a_hot_class_and_a_hot_signature(make_docs):
    """A third are copies of one text, a third near copies that share its signatures, and empty texts."""
    draw = random.Random(5)
    base = [f"w{n}" for n in range(60)]
    rows = [(i, " ".join(base)) for i in range(60)]
    for i in range(60, 120):
        words = list(base)
        words[draw.choice((0, 59))] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(i, draw.choice([None, "", "  ", f"alone {i} in here now"])) for i in range(120, 180)]
    wanted = sorted(((d, *c) for (d, _), c in zip(rows, components(rows, 5, 80), strict=True)), key=repr)
    found = jaccard.jaccard_components(make_docs(rows), shingle=5, percent=80)
    assert as_rows(found, "doc_id", "n_shingles", "component_id") == wanted
    kept = jaccard.drop_near_duplicates(make_docs(rows), shingle=5, percent=80)
    assert kept.count() == len({c for _, _, c in wanted})


def test_repeats_of_equal_rows_without_an_id(make_docs):
    """Copies of one text under a null id, and one text longer than a task's slice with a repeat across its border."""
    draw = random.Random(9)
    passage = " ".join(f"p{draw.randrange(10**6)}" for _ in range(90))
    copy = f"{passage} and an end of its own"
    rows = [(None, copy)] * 40 + [(3, f"before {passage} after"), (4, "short")]
    wanted = sorted(((doc, n, gone) for (doc, _), (n, gone, *_) in zip(rows, repeats(rows, 400), strict=True)), key=repr)
    found = suffixes.remove_repeats(make_docs(rows))
    assert as_rows(found, "doc_id", "n_bytes", "n_removed") == wanted

    long = [f"q{draw.randrange(10**9)}" for _ in range(60_000)]
    text = " ".join(long)
    border = 1 << 19
    again = text[border - 700 : border + 700]
    found = suffixes.remove_repeats(make_docs([(1, text), (2, f"{again}!")]))
    assert len(text) > border + 1000
    assert as_rows(found, "doc_id", "n_removed") == [(1, 1400), (2, 1400)]

