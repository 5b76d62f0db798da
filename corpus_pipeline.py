"""A training corpus from raw documents: five stages, each one operator of ``cleargrain.llm``.

Each stage works on all that its predecessor kept, is written as Parquet and read
again. The first four drop rows and return the columns of ``documents``; the last
packs what is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cleargrain.llm import decontaminate, exact_dedup, jaccard, packing, toxicity
from cleargrain.llm.queries import BYTE_BPE, TOXIC_AT, table
from cleargrain.plans import storage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=TOXIC_AT)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a Jaccard similarity of 0.8 over five-word shingles stays."""
    return jaccard.drop_near_duplicates(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten successive words of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the sequences of 2048 tokens."""
    return packing.pack_documents(docs, BYTE_BPE, end_id=0, limit=2048)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: A trained classifier and a tokenizer are not SQL; the tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = storage.write_then_read(stage(spark, docs, sf_dir), storage.fresh_folder(spark, f"stage-{name.replace(' ', '-')}"))
    return docs
