from cleargrain.llm import toxicity


def test_the_sample_holds_1500_toxic_and_3000_other_rows(spark, monkeypatch):
    """More labelled rows than the bound: the model learns from as many as it allows."""
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda examples, labels, **_: seen.append(labels) or toxicity.NEVER)
    docs = spark.range(9000).selectExpr("id as doc_id", "concat('text number ', id) as text")
    toxicity.fit(docs, docs.selectExpr("doc_id", "cast(doc_id % 3 = 0 as int) as toxic"))
    assert (int((seen[0] == 1).sum()), int((seen[0] == 0).sum())) == (1500, 3000)
