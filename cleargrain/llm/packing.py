"""Operator 2: best-fit packing of documents into sequences of a fixed length.

Best-two-fit works on the histogram of piece lengths, which has at most as many
rows as a sequence has places, however large the corpus. A bin starts with the
longest unpacked piece and takes the longest that fits until none does. If a gap
is left, its smallest piece gives way to two unpacked pieces that fit the wider
gap more tightly. The bin so found is repeated as often as the counts allow, so
the plan is a short list of bins with multiplicities for any number of pieces.

Pieces then find their places without meeting: a piece's rank among those of its
length comes from counts by task, and the rank says which bin takes it.

A text over the limit is cut into full pieces from its end; the first piece
holds the rest. Nulls and ties: a null text holds the end id alone; a null id is
kept; equal rows are packed one by one. Other columns are not read. An empty
table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleargrain.llm.common import narrow, ranges, running_base
from cleargrain.llm.encode import encoded
from cleargrain.plans import storage

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def cut(
    docs: DataFrame, tokenizer: str, *, end_id: int, limit: int, id_col: str = "doc_id", text_col: str = "text", tokens: bool = False
) -> DataFrame:
    """One row a piece; ``nth`` counts the pieces of the same length in the same task.

    With ``tokens`` the rows carry their ids as well.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(limit + 1, np.int64)
        for batch, ids, starts in encoded(batches, tokenizer, end_id):
            sizes = np.diff(starts)
            counts = -(-sizes // limit)
            doc = np.repeat(np.arange(len(sizes)), counts)
            piece = ranges(np.zeros(len(sizes), np.int64), counts)
            first = sizes - (counts - 1) * limit
            at = np.where(piece == 0, 0, first[doc] + (piece - 1) * limit)
            length = np.where(piece == 0, first[doc], limit)
            order = np.argsort(length, kind="stable")
            lengths, begins, many = np.unique(length[order], return_index=True, return_counts=True)
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(length)) - np.repeat(begins, many) + seen[length[order]]
            seen[lengths] += many
            data, place = ids.astype("<u4"), starts[doc] + at
            sums = [zlib.crc32(data[a : a + n]) for a, n in zip(place.tolist(), length.tolist(), strict=True)]
            columns = [
                batch.column("id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(at), pa.array(length),
                pa.array(sums, pa.int64()), pa.array(np.full(len(doc), part, np.int32)), pa.array(nth),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            if tokens:  # the pieces of a slice follow each other without gaps
                offsets = np.concatenate([place, [len(ids)]]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)))
                names.append("tokens")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return narrow(docs, id_col, text_col).mapInArrow(pieces, _PIECES + ", tokens array<int>" * tokens)


@dataclass(frozen=True)
class Bin:
    """``times`` sequences that each hold ``lengths``, the longest first."""

    times: int
    lengths: tuple[int, ...]


def _longest(left: np.ndarray, most: int) -> int:
    """The longest length up to ``most`` that is left, or 0."""
    found = np.flatnonzero(left[: most + 1] > 0)
    return int(found[-1]) if len(found) else 0


def _two(left: np.ndarray, gap: int, over: int) -> tuple[int, int] | None:
    """Two lengths left whose sum is the largest up to ``gap``, and over ``over``."""
    lengths = np.flatnonzero(left[: max(gap, 0)] > 0)
    if not len(lengths):
        return None
    at = np.searchsorted(lengths, gap - lengths, side="right") - 1
    other = np.where(at >= 0, lengths[np.maximum(at, 0)], 0)
    lower = np.where(at > 0, lengths[np.maximum(at - 1, 0)], 0)
    other = np.where((other == lengths) & (left[lengths] < 2), lower, other)
    sums = np.where(other > 0, lengths + other, 0)
    best = int(np.argmax(sums))
    return (int(lengths[best]), int(other[best])) if sums[best] > over else None


def best_two_fit(counts: dict[int, int], limit: int) -> list[Bin]:
    """Bins for the pieces counted by length (1 to ``limit``)."""
    left = np.zeros(limit + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    bins = []
    while first := _longest(left, limit):
        trial, held, gap = left.copy(), [first], limit - first
        trial[first] -= 1
        while gap and (length := _longest(trial, gap)):
            held.append(length)
            trial[length] -= 1
            gap -= length
        if gap and len(held) > 1 and (pair := _two(trial, gap + held[-1], held[-1])):
            held[-1:] = sorted(pair, reverse=True)
        held.sort(reverse=True)
        need = np.bincount(held, minlength=limit + 1)
        used = np.flatnonzero(need)
        times = int((left[used] // need[used]).min())
        left[used] -= times * need[used]
        bins.append(Bin(times, tuple(held)))
    return bins


def _plan(bins: list[Bin], limit: int) -> np.ndarray:
    """For each length of each bin: the length, the first rank taken, copies in a bin, first sequence, offset."""
    taken, rows, sequence = np.zeros(limit + 1, np.int64), [], 0
    for one in bins:
        offset = 0
        for length in sorted(set(one.lengths), reverse=True):
            copies = one.lengths.count(length)
            rows.append((length, taken[length], copies, sequence, offset))
            taken[length] += copies * one.times
            offset += copies * length
        sequence += one.times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, *, limit: int) -> DataFrame:
    """``pieces`` (a written table from ``cut``) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["rows"] for r in pieces.groupBy("length").agg(F.count("*").alias("rows")).collect()}
    total = sum(counts.values()) + 1
    plan = spark.sparkContext.broadcast(_plan(best_two_fit(counts, limit), limit))
    kept = [c for c in pieces.columns if c not in ("part", "nth")]
    schema = pieces.select(*kept).schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts, copies, sequences, offsets = plan.value.T
        keys = lengths * total + firsts
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = np.searchsorted(keys, length * total + rank, side="right") - 1
            nth = rank - firsts[row]
            places = [sequences[row] + nth // copies[row], offsets[row] + nth % copies[row] * length]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *map(pa.array, places)], names=schema.names)

    bases = running_base(pieces, "length", "part", F.count("*"))
    ranked = pieces.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    return ranked.select(*kept, "rank").mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, *, end_id: int = 0, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", tokens: bool = False
) -> DataFrame:
    """Cut, land the pieces in the shared folder, pack."""
    pieces = cut(docs, tokenizer, end_id=end_id, limit=limit, id_col=id_col, text_col=text_col, tokens=tokens)
    return pack(storage.write_then_read(pieces, storage.fresh_folder(docs.sparkSession, "pieces")), limit=limit)


def sequences(placed: DataFrame) -> DataFrame:
    """The sequences themselves from pieces placed with their tokens; a sequence never exceeds the limit."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "tokens")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.tokens").alias("tokens"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets")
    )
