"""Operator 10: repeated byte strings by anchors and fingerprints of whole strings.

Only strings of ``threshold`` bytes matter, so nothing is sorted or reranked at
growing offsets, as prefix doubling would: strings are named by fingerprints at a
few fixed lengths, and the names are counted. Three things keep the rows few
without changing the answer:

* The first ranks are those of sampled positions. In every string of ``threshold``
  bytes the seed with the smallest hash is its anchor, so equal strings have equal
  anchors at equal distances. A run of positions that share an anchor is one row.
  Runs whose anchor has a unique rank are done: nothing there repeats.
* A run's union string (from its first position to the end of its last string) is
  ranked next. Where two runs tie, every position of both repeats: one row again.
* What is left is split into runs of STEP positions. All strings of such a run
  share a core; a unique core ends the run. Only positions whose core ties, in
  texts that are not the same around it, are named one by one, by the pair of
  fingerprints of their first and last half, and these pairs are counted.

Ranks are names, 64-bit fingerprints that are always compared together with the
rank of the step before (128 bits). Counts use partial sums; a string that fills
a third of all rows meets as one partial row a task.

Bytes covered by a repeated string go; the rest is kept. Nulls and ties: a null
text is empty; texts shorter than the threshold keep every byte; repeated rows
are repeated strings; null ids are kept. Other columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleargrain.llm import bloom
from cleargrain.llm.common import mix, narrow, slices
from cleargrain.plans import storage

#: Positions of a run that are tested together.
STEP = 32
#: Positions of one text that are handled at a time.
SEGMENT = 1 << 19
_PLACE_BITS = 20

_random = np.random.default_rng(10)
_BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_ODD = int(_random.integers(1 << 62, 1 << 63)) | 1
_POWERS, _INVERSES = (
    np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(SEGMENT + (1 << 16), x, np.uint64)])) for x in (_ODD, pow(_ODD, -1, 1 << 64))
)


class Prints:
    """Fingerprints of any string of a segment of text."""

    def __init__(self, data: np.ndarray):
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * _POWERS[: len(data)], out=self._sums[1:])

    def of(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[first]) * _INVERSES[first])

    def every(self, size: int) -> np.ndarray:
        """Of all strings of ``size`` bytes."""
        count = len(self._sums) - size
        return mix((self._sums[size:] - self._sums[:-size]) * _INVERSES[:count])


def _smallest(seeds: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest seed in each window, the last of equal ones."""
    low = np.uint64((1 << _PLACE_BITS) - 1)
    value = (seeds & ~low) | (low - np.arange(len(seeds), dtype=np.uint64))
    size = 1
    while 2 * size <= width:
        value = np.minimum(value[:-size], value[size:])
        size *= 2
    if rest := width - size:
        value = np.minimum(value[:-rest], value[rest:])
    return (low - (value & low)).astype(np.int64)


def runs_of(data: np.ndarray, threshold: int, seed: int) -> tuple[np.ndarray, ...]:
    """first position, positions, distance of the anchor, rank of the anchor, rank of the union; by run."""
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    for start in range(0, len(data) - threshold + 1, SEGMENT):
        part = data[start : start + SEGMENT + threshold - 1]
        prints = Prints(part)
        seeds = prints.every(seed)
        anchor = _smallest(seeds, threshold - seed + 1)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        many = np.diff(np.append(first, len(anchor)))
        at = anchor[first]
        union = prints.of(first, first + many - 1 + threshold)
        union = mix(union + mix((at - first).astype(np.uint64) << np.uint64(32) | many.astype(np.uint64)))
        for held, new in zip(out, (first + start, many, at - first, seeds[at], union), strict=True):
            held.append(new)
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in out)


def _bytes(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint8)


def _lists(counts: list[int], values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    flat = np.concatenate(values) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int64) if flat.dtype == np.uint64 else flat, kind))


def seeded(rows: DataFrame, threshold: int, seed: int) -> DataFrame:
    """id, mark, and the runs of each text long enough as arrays."""

    def seed_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [runs_of(_bytes(x), threshold, seed) for x in batch.column("text")]
            counts = [len(x[0]) for x in found]
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            columns = [_lists(counts, [x[i] for x in found], kind) for i, kind in enumerate(kinds)]
            names = ["first", "many", "lead", "key", "block"]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), *columns], names=["id", "mark", *names])

    schema = "id long, mark long, first array<int>, many array<int>, lead array<int>, key array<long>, block array<long>"
    return rows.where(F.octet_length("text") >= threshold).select("id", "mark", F.col("text").cast("binary").alias("text")).mapInArrow(seed_runs, schema)


def _land(frame: DataFrame, purpose: str) -> DataFrame:
    return storage.write_then_read(frame, storage.fresh_folder(frame.sparkSession, purpose))


def with_texts(rows: DataFrame, wanted: DataFrame, parts: Column) -> DataFrame:
    """Texts (as bytes) of the documents that ``wanted`` names, each with its ``parts`` as a list.

    Texts that a filter of the names rules out never leave their task; a list is
    bounded by its own text.
    """
    lists = wanted.groupBy("id", "mark").agg(F.collect_list(parts).alias("parts"))
    held = bloom.holding(lists.select(F.col("mark").alias("h")))
    chosen = rows.where(bloom.maybe(held, F.col("mark"))).select("id", "mark", F.col("text").cast("binary").alias("text"))
    same = chosen["id"].eqNullSafe(lists["id"]) & (chosen["mark"] == lists["mark"])
    # Equal rows each bring the parts; their runs are partners already, so counts of the others stay right.
    return chosen.join(lists, same).select(chosen["id"], chosen["mark"], "text", "parts")


def _cores(joined: DataFrame, threshold: int) -> DataFrame:
    """Runs of STEP positions: run, partner, first, many, core and union ranks."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for text, parts in zip(batch.column("text"), batch.column("parts"), strict=True):
                data, parts = _bytes(text), parts.values
                run, partner, first, many, lead, key = (
                    parts.field(n).to_numpy(zero_copy_only=False) for n in ("run", "partner", "first", "many", "lead", "key")
                )
                near, far = lead - many + 1, lead  # distances of the last and the first position from the anchor
                steps = far // STEP - near // STEP + 1
                which = np.repeat(np.arange(len(run)), steps)
                step = np.arange(len(which)) - np.repeat(np.cumsum(steps) - steps, steps) + np.repeat(near // STEP, steps)
                anchor = (first + lead)[which].astype(np.int64)
                begin = anchor - np.minimum(step * STEP + STEP - 1, far[which])
                end = anchor - np.maximum(step * STEP, near[which])
                tag = mix(key[which].astype(np.int64).view(np.uint64) + step.astype(np.uint64))
                core_first, core_end = anchor - step * STEP, anchor - step * STEP - STEP + 1 + threshold
                core = _strings(data, core_first, core_end)
                union = _strings(data, begin, end + threshold)
                shape = ((anchor - begin) << 32 | (end - begin)).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(run[which]), pa.array(partner[which], pa.bool_()), pa.array(begin, pa.int32()), pa.array(end - begin + 1, pa.int32()),
                        pa.array(anchor - begin, pa.int32()), pa.array(key[which], pa.int64()),
                        pa.array(mix(core + tag).view(np.int64)), pa.array(mix(union + mix(tag + shape)).view(np.int64)),
                    ],
                    names=["run", "partner", "first", "many", "lead", "key", "core", "union"],
                )

    return joined.mapInArrow(split, "run long, partner boolean, first int, many int, lead int, key long, core long, union long")


def _strings(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of strings of a text of any length, segment by segment."""
    out = np.empty(len(first), np.uint64)
    for part in np.unique(first // SEGMENT):
        rows = np.flatnonzero(first // SEGMENT == part)
        base = int(part) * SEGMENT
        prints = Prints(data[base : int(end[rows].max())])
        out[rows] = prints.of(first[rows] - base, end[rows] - base)
    return out


def _pairs(joined: DataFrame, threshold: int) -> DataFrame:
    """run, partner, place and the rank pair (first half, last half) of every position."""
    half = threshold // 2

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for text, parts in zip(batch.column("text"), batch.column("parts"), strict=True):
                data, parts = _bytes(text), parts.values
                run, partner, first, many, lead, key = (
                    parts.field(n).to_numpy(zero_copy_only=False) for n in ("run", "partner", "first", "many", "lead", "key")
                )
                which = np.repeat(np.arange(len(run)), many)
                nth = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
                place = first[which].astype(np.int64) + nth
                tag = mix(key[which].astype(np.int64).view(np.uint64) + (lead[which] - nth).astype(np.uint64))
                r1 = mix(_strings(data, place, place + half) + tag).view(np.int64)
                r2 = _strings(data, place + half, place + threshold).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(run[which]), pa.array(partner[which], pa.bool_()), pa.array(place, pa.int32()), pa.array(r1), pa.array(r2)],
                    names=["run", "partner", "place", "r1", "r2"],
                )

    return joined.mapInArrow(expand, "run long, partner boolean, place int, r1 long, r2 long")


def repeated_spans(rows: DataFrame, *, threshold: int, seed: int) -> DataFrame:
    """id, mark, first, end: strings of bytes that repeat; they may overlap.

    ``rows``: id, text, mark (a hash of the text).
    """
    table = _land(seeded(rows, threshold, seed), "runs")
    zipped = F.arrays_zip("first", "many", "lead", "key", "block")
    runs = table.select("id", "mark", F.explode(zipped).alias("r")).select("id", "mark", "r.*")
    # Ranks of the anchors and, in them, of the unions.
    taken = [F.first(c).alias(c) for c in ("id", "mark", "first", "many", "lead")]
    blocks = _land(runs.groupBy("key", "block").agg(F.count("*").alias("copies"), *taken), "blocks")
    whole = blocks.where("copies > 1").select("key", "block")
    done = runs.join(whole, ["key", "block"], "left_semi").select("id", "mark", "first", (F.col("first") + F.col("many") + threshold - 1).alias("end"))

    mixed = blocks.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1").select("key")
    open_ = blocks.join(mixed, "key", "left_semi").select(
        "id", "mark", "first", "many", "lead", "key", (F.col("copies") > 1).alias("partner"), F.monotonically_increasing_id().alias("run")
    )
    open_ = _land(open_, "open")
    fields = F.struct("run", "partner", "first", "many", "lead", "key")
    steps = _land(_cores(with_texts(rows, open_, fields), threshold), "steps")
    # Ranks of the cores and, in them, of the unions.
    unions = steps.groupBy("core", "union").agg(F.count("*").alias("copies"))
    cores = unions.groupBy("core").agg(F.count("*").alias("kinds"))
    ranked = steps.join(unions, ["core", "union"]).join(cores, "core")
    ranked = ranked.where("kinds > 1 or (copies > 1 and not partner)")
    ranked = _land(ranked, "ranked")
    names = open_.select("run", "id", "mark")
    tied = ranked.where("copies > 1 and not partner").join(names, "run").select(
        "id", "mark", "first", (F.col("first") + F.col("many") + threshold - 1).alias("end")
    )

    left = ranked.where("kinds > 1").withColumn("partner", F.col("partner") | (F.col("copies") > 1)).join(names, "run")
    places = _land(_pairs(with_texts(rows, left, fields), threshold), "pairs")
    same = places.groupBy("r1", "r2").agg(F.count("*").alias("copies")).where("copies > 1")
    single = places.where("not partner").join(same, ["r1", "r2"], "left_semi").join(names, "run").select(
        "id", "mark", F.col("place").alias("first"), (F.col("place") + threshold).alias("end")
    )
    return done.unionByName(tied).unionByName(single)


def remove_repeats(
    docs: DataFrame, *, threshold: int = 400, seed: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed runs of bytes, maximal), kept (the remaining bytes)."""
    rows = narrow(docs, id_col, text_col).withColumn("mark", F.xxhash64("text"))
    spans = _land(repeated_spans(rows, threshold=threshold, seed=seed), "spans")
    lists = spans.groupBy("id", "mark").agg(F.collect_set(F.struct("first", "end")).alias("parts"))
    held = bloom.holding(lists.select(F.col("mark").alias("h")))
    marked = rows.withColumn("maybe", bloom.maybe(held, F.col("mark")))
    none = F.array().cast("array<struct<first: int, end: int>>")
    clear = marked.where("not maybe").select("id", F.col("text").cast("binary").alias("text"), none.alias("parts"))
    same = marked["id"].eqNullSafe(lists["id"]) & (marked["mark"] == lists["mark"])
    hit = marked.where("maybe").join(lists, same, "left").select(
        marked["id"], F.col("text").cast("binary").alias("text"), F.coalesce("parts", none).alias("parts")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, removed, gone, kept = [], [], [], []
            for text, parts in zip(batch.column("text"), batch.column("parts"), strict=True):
                data, merged = text.as_py(), _merged(parts.values)
                left, at = [], 0
                for first, end in merged:
                    left.append(data[at:first])
                    at = end
                left.append(data[at:])
                kept.append(b"".join(left))
                sizes.append(len(data))
                removed.append(len(data) - len(kept[-1]))
                gone.append([{"first": a, "end": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(gone, _SPANS), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
            )

    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<first: int, end: int>>, kept binary"
    return clear.unionByName(hit).mapInArrow(cut, schema)


_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))


def _merged(parts: pa.StructArray | None) -> list[tuple[int, int]]:
    """Maximal runs; runs that touch become one."""
    if parts is None or not len(parts):
        return []
    first, end = (parts.field(n).to_numpy(zero_copy_only=False) for n in ("first", "end"))
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], first[1:] > end[:-1]])
    return list(zip(first[new].tolist(), end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)].tolist(), strict=True))


