"""Operator 1: token ids in Parquet files that allow selective reads.

One row a document, in ascending id order over the files and inside them:

* ``tokens``: list of int. Dictionary pages hold the ids that a row group uses;
  where a dictionary would not pay, version 2 pages fall back to delta encoding.
* ``doc_id``, ``part``, ``place``, ``n_tokens``: metadata, readable without the
  tokens. ``part`` is the file's number in order, ``place`` the number of ids
  that precede the document in its file.

Row groups and pages are small enough that the column and offset indexes, which
the writer adds, let a reader skip to a few documents.

Nulls and ties: a null text is empty and holds the end id alone; a null id sorts
first; rows with equal ids keep their own rows, next to each other. Columns other
than the id and the text are not read. An empty table gives files without rows. A
very long text is encoded whole, as one row in a step of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cleargrain.llm.common import narrow
from cleargrain.llm.encode import encoded

SCHEMA = "doc_id long, part int, place long, n_tokens long, tokens array<int>"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("part", pa.int32()), ("place", pa.int64()), ("n_tokens", pa.int64()), ("tokens", pa.list_(pa.int32()))]
)


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, *, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    row_group_bytes: int = 16 << 20, page_bytes: int = 128 << 10, page_rows: int = 2000,
) -> None:
    """Encode every whole text and write the files under ``path``.

    The texts are dealt by ranges of the id before they are encoded; a task then
    writes one file. Equal ids are dealt by their text as well.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        for batch, ids, starts in encoded(batches, tokenizer, end_id):
            rows = len(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(np.full(rows, part, np.int32)),
                    pa.array(starts[:-1] + place),
                    pa.array(np.diff(starts)),
                    pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids)),
                ],
                schema=_ARROW,
            )
            place += int(starts[-1])

    order = ["id", F.xxhash64("text")]
    rows = narrow(docs, id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order)
    (
        rows.mapInArrow(encode, SCHEMA)
        .write.mode("overwrite")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .option("compression", "zstd")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str, *, tokens: bool = True) -> DataFrame:
    """The files with ``start``, the number of ids in all documents before a row's.

    Without ``tokens`` only the metadata columns are read. The sums before each
    file have one row a file, which bounds what is broadcast.
    """
    files = spark.read.schema(SCHEMA).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.groupBy("part").agg(F.sum("n_tokens").alias("ids")).select(
        "part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base")
    )
    columns = ["doc_id", "n_tokens", *(["tokens"] if tokens else [])]
    return files.join(F.broadcast(bases), "part").select((F.col("base") + F.col("place")).alias("start"), *columns)


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of a document's ids as little-endian 32-bit integers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            ids, starts = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "n_tokens", "tokens").mapInArrow(
        digest, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
