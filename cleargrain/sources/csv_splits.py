"""CSV files whose quoted fields hold line breaks, read in as many tasks as a file has splits.

A line break ends a record unless a quoted field is open, which the number of quotes
before it in the file tells: odd means open. Two passes find that out without reading
a file in one task:

1. Every split counts the quotes of its lines; one bit a split reaches the driver,
   which adds them up along each file. Then it is known which splits begin inside a
   quoted field.
2. Every split joins its lines to records from its true state. What a split begins or
   ends in the middle of comes out as a fragment, two a split at most; fragments of one
   record are put together by their places.

Both passes see the splits that Spark makes of the files. If they differ (files or
split sizes changed in between), the second pass fails rather than misread.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
#: A record in which quotes stand around whole fields, or doubled inside them.
REGULAR = rf"(?s)^{_FIELD}(?:,{_FIELD})*+$"
_WHOLE, _HEAD, _TAIL, _HEADER = 0, 1, 2, 3
_SCHEMA = "file string, block long, line long, kind int, record string"

State = dict[tuple[str, int], bool]

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks get the code itself, so workers need not have the package


def _lines(spark: SparkSession, path: str) -> DataFrame:
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return spark.read.option("lineSep", "\n").text(path).select(*place, "value")


def begins_inside(lines: DataFrame) -> State:
    """For each split, whether it begins inside a quoted field: one bit a split, added up along each file."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    bits = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd")).collect()
    state: State = {}
    file, inside = None, False
    for row in sorted(bits, key=lambda r: (r["file"], r["block"])):
        inside = inside and row["file"] == file
        file = row["file"]
        state[file, row["block"]] = inside
        inside ^= bool(row["odd"])
    return state


def _joined(batches: Iterator[pa.RecordBatch], state: State) -> Iterator[pa.RecordBatch]:
    """Records and fragments of the splits that a task reads one after the other."""
    split, pending, inside, began_inside, first, line, headed = None, [], False, False, 0, 0, True

    def out(records: pa.Array, lines: np.ndarray, kind: int) -> pa.RecordBatch:
        nonlocal headed
        count, kinds = len(records), np.full(len(records), kind, np.int32)
        if not headed and len(full := [i for i in range(min(count, 1000)) if records[i].as_py().strip()]):
            kinds[full[0]], headed = _HEADER, True
        columns = [pa.array([split[0]] * count, pa.string()), pa.array([split[1]] * count, pa.int64()), pa.array(lines, pa.int64()), pa.array(kinds)]
        return pa.RecordBatch.from_arrays([*columns, records], names=["file", "block", "line", "kind", "record"])

    def rest() -> Iterator[pa.RecordBatch]:
        """What the split ends in the middle of; a split without a record's begin is a head that does not end either."""
        if pending:
            yield out(pa.array(["\n".join(pending)], pa.string()), np.array([first]), _HEAD if began_inside else _TAIL)

    for batch in batches:
        files, blocks, values = batch.column("file"), batch.column("block"), batch.column("value").cast(pa.string())
        blocks = blocks.to_numpy()
        same = np.ones(len(batch), bool)
        if len(batch) > 1:
            changed = pc.not_equal(files.slice(1), files.slice(0, len(batch) - 1)).to_numpy(zero_copy_only=False)
            same[1:] = ~changed & (blocks[1:] == blocks[:-1])
        edges = [0, *np.flatnonzero(~same).tolist(), len(batch)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a == b:
                continue
            if split != (now := (files[a].as_py(), int(blocks[a]))):
                if split is not None:
                    yield from rest()
                if now not in state:
                    raise ValueError(f"The splits of {now[0]} are no longer those whose quotes were counted")
                split, pending, inside, first, line, headed = now, [], state[now], 0, 0, now[1] > 0
                began_inside = inside
            own = values.slice(a, b - a)
            odd = pc.count_substring(own, '"').to_numpy(zero_copy_only=False) % 2
            after = (np.cumsum(odd) + inside) % 2  # whether a field is open behind each line
            before = np.concatenate([[int(inside)], after[:-1]])
            starts = np.flatnonzero(before == 0)
            lead = int(starts[0]) if len(starts) else len(own)
            if lead:
                pending += own.slice(0, lead).to_pylist()
                if not after[lead - 1]:
                    yield out(pa.array(["\n".join(pending)], pa.string()), np.array([first]), _HEAD if began_inside else _WHOLE)
                    pending, began_inside = [], False
            inside = bool(after[-1])
            if len(starts):
                if inside:  # the last record stays open
                    pending, first = own.slice(int(starts[-1])).to_pylist(), line + int(starts[-1])
                    own, starts = own.slice(0, int(starts[-1])), starts[:-1]
                if len(starts):
                    offsets = np.append(starts, len(own)).astype(np.int32)
                    records = own.slice(lead) if len(starts) == len(own) - lead else pc.binary_join(pa.ListArray.from_arrays(offsets, own), "\n")
                    yield out(records, line + starts, _WHOLE)
            line += b - a
    if split is not None:
        yield from rest()


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, block and line (the place of a record's first line), is_header, and the text of every record."""
    lines = _lines(spark, path)
    state = begins_inside(lines)
    found = lines.mapInArrow(lambda batches: _joined(batches, state), _SCHEMA)
    kept = ["file", "block", "line", (F.col("kind") == _HEADER).alias("is_header"), "record"]
    if any(state.values()):
        begun = Window.partitionBy("file").orderBy("block", "line")
        parts = found.where(F.col("kind").isin(_HEAD, _TAIL)).withColumn("nth", F.count(F.when(F.col("kind") == _TAIL, 1)).over(begun))
        pieces = F.array_sort(F.collect_list(F.struct("block", "line", "record")))
        whole = parts.groupBy("file", "nth").agg(pieces.alias("p")).select(
            "file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["line"].alias("line"), F.lit(False).alias("is_header"),
            F.array_join("p.record", "\n").alias("record"),
        )
        found = found.where(~F.col("kind").isin(_HEAD, _TAIL)).select(*kept).unionByName(whole)
    else:
        found = found.select(*kept)
    ended = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return found.withColumn("record", ended).where(F.trim("record") != "")


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """file, block, line and the named columns of all records, as text; None if the files need a reader of whole files.

    That is so where quotes stand inside fields without quotes: counting them says
    nothing then. The records are looked at once for that and for their headers.
    Empty fields, and missing ones of a short record, are NULL, as Spark's own reader
    has it; further fields of a long record go.
    """
    columns = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).columns
    found = records(spark, path)
    values = F.from_csv("record", F.lit(", ".join(f"`{c}` string" for c in columns)), {"escape": '"'})
    names = F.array(*[values[c] for c in columns])
    irregular = F.contains("record", F.lit('"')) & ~F.rlike("record", F.lit(REGULAR))
    unlike = F.col("is_header") & ~names.eqNullSafe(F.array(*map(F.lit, columns)))
    seen = found.agg(F.max(irregular).alias("irregular"), F.max(unlike).alias("unlike")).first()
    if seen["irregular"]:
        return None
    if seen["unlike"]:
        raise ValueError(f"The headers of the files in {path} disagree")
    rows = found.where("not is_header").select("file", "block", "line", values.alias("v"))
    return rows.select("file", "block", "line", *[F.col("v")[c].alias(c) for c in columns])
