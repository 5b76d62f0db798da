"""The registered queries on the smallest tables, and the pipeline stage by stage."""

import os

import duckdb
import pytest
from brute import LOWER, components, contamination
from pyspark.sql import functions as F

import corpus_pipeline
from cleargrain.llm import toxicity
from cleargrain.llm.oracle import ORACLES
from cleargrain.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, engine, name):
    answer = engine.execute(ORACLES[name])
    names = [column[0] for column in answer.description]
    expected = answer.fetchall()
    frame = QUERIES[name](spark, SF)
    assert sorted(frame.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r) for r in frame.select(*names).collect()))) == sorted(map(repr, expected))


def test_numbers_of_all_operators():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


def test_stages(spark):
    """What each stage does to its own input, worked out row by row."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
        after = stage(spark, docs, SF)
        if name == "best-fit packing":
            assert {r.doc_id for r in after.select("doc_id").distinct().collect()} == {d for d, _ in before}
            break
        assert after.columns == columns
        stays = sorted(r.doc_id for r in after.collect())
        if name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            scored = docs.select("doc_id", toxicity.score(model, docs).alias("s")).collect()
            assert stays == sorted(r.doc_id for r in scored if r.s < corpus_pipeline.TOXIC_AT)
        elif name == "exact dedup":
            best = {}
            for d, t in before:
                best[(t or "").translate(LOWER)] = d
            assert stays == sorted(best.values())
        elif name == "n-gram Jaccard join":
            assert stays == sorted(d for (d, _), (_, c) in zip(before, components(before, 5, 80), strict=True) if d == c)
        else:
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            assert stays == sorted(d for (d, _), (_, h, _) in zip(before, contamination(before, items, 10), strict=True) if not h)
        docs = docs.where(F.col("doc_id").isin(stays))


def test_run_ends_in_packed_pieces(spark):
    frame = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(frame.columns) and frame.count() > 0
