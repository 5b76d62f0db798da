"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step of a Python task holds unpacked.
SLICE_BYTES = 1 << 19
#: Bytes of the Arrow batches between Spark and Python, where the session names none.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Lower case for A-Z alone; every other byte maps to itself.
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


#: A key with more than this share of the rows is hot: fewer than 1 / HOT_KEY_SHARE keys are.
HOT_KEY_SHARE = 0.001

T = TypeVar("T")

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the workers import this package wherever they run, in batches of bounded bytes; once a session.

    A package that runs from an archive came by ``--py-files`` already.
    """
    context, package = spark.sparkContext, Path(__file__).resolve().parent.parent
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    if context.getConf().get(_BATCH_SETTING) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    if not package.is_dir():
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="cleargrain-"), "cleargrain.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)


def narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` and ``text`` alone, whatever else the table holds; a null text is empty."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", using: tuple | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most SLICE_BYTES of text, or one row, for a task that holds ``using`` or nothing."""
    let_go(using)
    for batch in batches:
        for first, last in cuts(batch.column(column)):
            yield batch.slice(first, last - first)
    release()  # workers outlive their tasks


def release() -> None:
    """Give all free memory back to the system, also what the C library keeps."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


_held: dict[tuple, object] = {}


def let_go(but: tuple | None = None) -> None:
    """Drop the large object that an earlier task left in this worker, unless it is ``but``."""
    if _held and but not in _held:
        _held.clear()
        release()


def hold(key: tuple, build: Callable[[], T]) -> T:
    """A large object for the tasks of this worker, which holds one at a time."""
    let_go(key)
    if key not in _held:
        _held[key] = build()
    return _held[key]


def cuts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most SLICE_BYTES of text each, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over 64 bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indexes of the ranges, one range after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()), dtype=np.int64)


def join_facts(rows: DataFrame, facts: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """``rows`` joined with ``facts``, whose column ``size`` says how many of the ``total`` rows have the key.

    The facts of hot keys are broadcast, and their rows stay where they are; the share
    bounds the number of such keys whatever the input. All other rows meet by key.
    """
    least = total * HOT_KEY_SHARE
    hot, other = facts.where(F.col(size) > least), facts.where(F.col(size) <= least)
    here = rows.join(F.broadcast(hot), keys)
    there = rows.join(F.broadcast(hot.select(*keys).distinct()), keys, "left_anti").join(other, keys)
    return here.unionByName(there)


def running_base(rows: DataFrame, group: str, block: str, count: Column) -> DataFrame:
    """``base``: what the earlier blocks of a group count. One row a group and block
    enters the window, so a group costs as many rows as the table had tasks."""
    from pyspark.sql import Window

    sums = rows.groupBy(group, block).agg(count.alias("_rows"))
    before = Window.partitionBy(group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(group, block, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("base"))
