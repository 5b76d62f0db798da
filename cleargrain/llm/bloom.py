"""Bloom filters over 64-bit hashes, one machine word a hash.

A hash picks one 64-bit word and four of its bits. Words are combined by Spark
aggregates; the driver sees at most MAX_WORDS of them, whatever the input, and
broadcasts those. A fuller filter lets more rows through to the exact step that
always follows it; it never loses one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 16 MB.
MAX_WORDS = 1 << 21
_BITS = 4


def words_for(rows: int) -> int:
    """A power of two of words, with 32 bits a row or more up to MAX_WORDS."""
    return min(MAX_WORDS, max(64, 1 << (rows // 2).bit_length()))


def _word(hashed: Column, words: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - (words.bit_length() - 1))


def _mask(hashed: Column) -> Column:
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(hashed, 6 * i).bitwiseAND(63).cast("int")) for i in range(_BITS)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def _gather(words: DataFrame, count: int) -> np.ndarray:
    """Rows (word, bits) as one array."""
    found, out = words.toArrow(), np.zeros(count, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out


def holding(hashes: DataFrame, column: str = "h") -> Broadcast:
    """A filter that holds every hash."""
    count = words_for(hashes.count())
    h = F.col(column)
    words = hashes.where(h.isNotNull()).groupBy(_word(h, count).alias("word")).agg(F.bit_or(_mask(h)).alias("bits"))
    return hashes.sparkSession.sparkContext.broadcast(_gather(words, count))


def repeated(hashes: DataFrame, column: str = "h") -> Broadcast:
    """First pass: a filter of the bits that two rows or more have set.

    Equal hashes are counted with partial sums first, so many copies of one hash
    meet as one row a task. A word then sees its distinct masks: a bit goes to the
    filter when a second mask sets it, or a mask that came more than once.
    """
    count = words_for(hashes.count())
    h = F.col(column)
    masks = hashes.where(h.isNotNull()).groupBy(_word(h, count).alias("word"), _mask(h).alias("mask")).agg(F.count("*").alias("rows"))
    zero = F.struct(F.lit(0).cast("long").alias("once"), F.lit(0).cast("long").alias("twice"))
    folded = F.aggregate(
        F.collect_list("mask"), zero,
        lambda a, m: F.struct(
            a["once"].bitwiseOR(m).alias("once"), a["twice"].bitwiseOR(a["once"].bitwiseAND(m)).alias("twice")
        ),
    )
    sure = F.coalesce(F.bit_or(F.when(F.col("rows") > 1, F.col("mask"))), F.lit(0))
    words = masks.groupBy("word").agg(folded["twice"].bitwiseOR(sure).alias("bits")).where("bits != 0")
    return hashes.sparkSession.sparkContext.broadcast(_gather(words, count))


def held(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Second pass, in a task: whether the filter may hold each hash."""
    h = hashes.astype(np.int64).view(np.uint64)
    at = (h >> np.uint64(64 - (len(words).bit_length() - 1))).astype(np.int64)
    mask = np.zeros(len(h), np.uint64)
    for i in range(_BITS):
        mask |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
    return (words.view(np.uint64)[at] & mask) == mask


def maybe(filter_: Broadcast, hashed: Column) -> Column:
    """The second pass as a column over a hash without nulls."""

    @F.pandas_udf("boolean")
    def look(h: pd.Series) -> pd.Series:
        return pd.Series(held(filter_.value, h.to_numpy(np.int64)))

    return look(hashed)
