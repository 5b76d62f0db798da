"""Operator 3: shards by jump consistent hashing.

The shard follows from the key and the number of shards alone, without a ring
table. With one more shard a key stays or moves into the new shard, so 1/(n+1)
of the rows move.

The shard files are written once, dealt by shard with Spark's rebalance, which
splits a large shard over several files and tasks. A file's rows carry their
place, so a row's slot in its shard is its place plus the rows of the shard's
earlier files: gapless, without sorting or gathering a shard.

Nulls and ties: a null key is hashed as its own key; a null text has size 8 and
an empty text's checksum; equal rows get slots of their own. Other columns are
not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cleargrain.llm.common import running_base, ship

_NULL_KEY = 0x6E756C6C
_FILES = "doc_id long, text string, shard int, grown_shard int, block int, place long"


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash (Lamping and Veach) of 64-bit keys."""
    state = keys.astype(np.uint64)
    shard, jump = np.full(len(state), -1, np.int64), np.zeros(len(state), np.int64)
    while (active := np.flatnonzero(jump < shards)).size:
        shard[active] = jump[active]
        state[active] = state[active] * np.uint64(2862933555777941757) + np.uint64(1)
        divisor = ((state[active] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        jump[active] = ((shard[active] + 1) * (float(1 << 31) / divisor)).astype(np.int64)
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a long key as a column."""

    @F.pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64), shards), dtype="int32")

    return jump(F.coalesce(key.cast("long"), F.lit(_NULL_KEY)))


def write_shards(docs: DataFrame, path: str, shards: int, *, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Files under ``path/shard=N`` with id, text, the shard after growth by one, and the rows' places."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, seen = TaskContext.get().partitionId(), np.zeros(shards, np.int64)
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            order = np.argsort(shard, kind="stable")
            held, first, many = np.unique(shard[order], return_index=True, return_counts=True)
            places = np.empty(len(shard), np.int64)
            places[order] = np.arange(len(shard)) - np.repeat(first, many) + np.repeat(seen[held], many)
            seen[held] += many
            blocks = pa.array(np.full(len(shard), block, np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, blocks, pa.array(places)], names=[*batch.schema.names, "block", "place"])

    ship(docs.sparkSession)
    key = F.col(id_col)
    dealt = docs.select(
        key.cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        shard_of(key, shards).alias("shard"), shard_of(key, shards + 1).alias("grown_shard"),
    ).hint("rebalance", "shard")
    dealt.mapInArrow(place, _FILES).write.mode("overwrite").partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, *, texts: bool = True) -> DataFrame:
    """The files with each row's ``slot`` in its shard."""
    files = spark.read.schema(_FILES).parquet(path)
    bases = running_base(files, "shard", "block", F.count("*"))
    columns = ["doc_id", *(["text"] if texts else []), "shard", "grown_shard"]
    return files.join(bases, ["shard", "block"]).select(*columns, (F.col("base") + F.col("place")).alias("slot"))
