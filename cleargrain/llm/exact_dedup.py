"""Operator 8: exact duplicates by two-pass Bloom filtering.

Pass one builds a filter of the hash bits that more than one row has set. Pass
two sends only rows whose hash the filter may hold through a shuffle, where the
full digests group them exactly; every other row is alone and passes straight
through. Texts are equal when identical after A-Z alone is lower-cased.

Of equal texts the row with the largest id stays. Nulls and ties: a null text is
an empty one; a null id is smaller than any other; rows with the same id and text
are all marked kept by ``group_copies`` and leave one behind in
``drop_duplicates``, which passes columns of any name through unread. An empty
table gives no rows. A very long text is hashed whole, in its task. A hot group meets
as one partial result a task, and its rows take that result from a broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleargrain.llm import bloom
from cleargrain.llm.common import ASCII_LOWER, join_facts, narrow
from cleargrain.plans import storage


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, sha256 of the normalised text, and its first 64 bits ``h``."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            sums = [hashlib.sha256(x.as_py().translate(ASCII_LOWER)).digest() for x in texts]
            first = np.frombuffer(b"".join(x[:8] for x in sums), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sums, pa.binary()), pa.array(first)], names=["id", "sha", "h"])

    return narrow(docs, id_col, text_col).mapInArrow(digest, "id long, sha binary, h long")


def group_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, sha, keep_id (of the row that stays), group_size, kept."""
    spark = docs.sparkSession
    rows = storage.write_then_read(digests(docs, id_col, text_col), storage.fresh_folder(spark, "digests"))
    seen = bloom.repeated(rows.select("h"))
    marked = rows.withColumn("maybe", bloom.maybe(seen, F.col("h")))
    alone = marked.where("not maybe").select(
        "id", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    several = marked.where("maybe").select("id", "sha")
    groups = several.groupBy("sha").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = storage.write_then_read(groups, storage.fresh_folder(spark, "groups"))
    joined = join_facts(several, groups, ["sha"], "group_size", rows.count()).select(
        "id", "sha", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept")
    )
    return alone.unionByName(joined)


def drop_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with their columns as they were.

    Rows outside the filter pass with their texts unshuffled; of the others the
    whole row with the largest id is found first, and repeated rows (same id, same
    text) leave one behind.
    """
    spark = docs.sparkSession
    rows = storage.write_then_read(digests(docs, id_col, text_col), storage.fresh_folder(spark, "digests"))
    seen = bloom.repeated(rows.select("h"))

    @F.pandas_udf("sha binary, maybe boolean")
    def hashed(texts: pd.Series) -> pd.DataFrame:
        sums = [hashlib.sha256((x or "").encode().translate(ASCII_LOWER)).digest() for x in texts]
        first = np.frombuffer(b"".join(x[:8] for x in sums), np.int64)
        return pd.DataFrame({"sha": sums, "maybe": bloom.held(seen.value, first)})

    look = hashed.asNondeterministic()  # else the filters below are pushed under it and every text is hashed twice
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.select(F.struct(*columns).alias("_row"), look(F.col(text_col)).alias("_seen"))
    alone = marked.where("not _seen.maybe").select("_row.*")
    several = marked.where("_seen.maybe").select("_row", F.col("_seen.sha").alias("_sha"))
    best = rows.where(bloom.maybe(seen, F.col("h"))).groupBy("sha").agg(F.max("id").alias("keep_id"))
    matches = (several["_sha"] == best["sha"]) & several[f"_row.{id_col}"].cast("long").eqNullSafe(best["keep_id"])
    kept = several.join(best, matches, "left_semi").dropDuplicates(["_sha"]).select("_row.*")
    return alone.unionByName(kept)
