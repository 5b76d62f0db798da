from pyspark.sql import functions as F

from cleargrain.llm import jaccard


def test_pairs_of_a_large_signature_spread_over_keys(spark):
    """Every pair of a signature meets once, and no join key holds more than a part of a large one."""
    sizes = {1: 1500, 2: 3, 3: jaccard.DEAL}
    rows = [(sig, 10_000 * sig + n, size) for sig, size in sizes.items() for n in range(size)]
    members = spark.createDataFrame(rows, "sig long, node long, many long")
    other = members.select("sig", F.col("node").alias("b"), F.col("many").alias("among"))
    joined = jaccard.dealt(members, other)
    assert {r.sig: (r.rows, r.pairs) for r in joined.groupBy("sig").agg(F.count("*").alias("rows"), F.countDistinct("node", "b").alias("pairs")).collect()} == {
        sig: (size**2, size**2) for sig, size in sizes.items()
    }
    keys = joined.groupBy("sig", "deal").agg(F.countDistinct("node").alias("nodes")).collect()
    assert max(r.nodes for r in keys) <= 1.3 * jaccard.DEAL and len([r for r in keys if r.sig == 1]) == 3
    assert len([r for r in keys if r.sig != 1]) == 2


def test_full_turn_of_a_large_group_finds_every_link(spark, monkeypatch):
    """Texts that share half of their words, of which only planted pairs link, with signatures dealt over many keys."""
    monkeypatch.setattr(jaccard, "DEAL", 8)
    common = " ".join(f"c{n}" for n in range(60))
    texts = [common + " " + " ".join(f"d{n}x{k}" for k in range(60)) for n in range(60)]
    rows = [(n, t) for n, t in enumerate(texts)] + [(100 + n, t + " end") for n, t in enumerate(texts[:5])]
    keys = []
    plain = jaccard.dealt
    monkeypatch.setattr(jaccard, "dealt", lambda m, o: keys.append(m.select("sig").distinct().count()) or plain(m, o))
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4, percent=85)
    assert {r.doc_id: r.component_id for r in found.collect()} == {n: n for n in range(60)} | {100 + n: n for n in range(5)}
    assert keys and keys[0] > 0
