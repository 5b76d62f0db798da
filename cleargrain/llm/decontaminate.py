"""Operator 6: benchmark decontamination with one Aho-Corasick automaton.

Words are runs of digits, ASCII letters (lower-cased) and bytes beyond ASCII.
Every ``window`` successive words of an item are one pattern; an item with fewer
words is one pattern as a whole. The automaton scans a document's normalised
words once and maps each hit back to word numbers and to places in the original.

Benchmarks over ``max_bytes`` of text are split by item into blocks of about that
size with an automaton each; each block is a scan of its own, and a document's
hits from all blocks are merged.

Nulls and ties: null or wordless texts and items hit nothing; items with equal
windows are all named; an item's null id is dropped from the names, not from the
hits. Repeated documents are judged one by one. Empty tables are fine. Other
columns are not read.
"""

from __future__ import annotations

import bisect
import re
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cleargrain.llm.common import narrow, ship, slices
from cleargrain.plans import storage

_TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO_WORDS).split()


def patterns(items: list[tuple[object, str | None]], window: int) -> dict[str, tuple[int, list]]:
    """Window -> its number of words and the items that hold it. Bytes are spelled as Latin-1, a space on both sides."""
    found: dict[str, tuple[int, list]] = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            key = " " + b" ".join(words[i : i + size]).decode("latin-1") + " "
            names = found.setdefault(key, (size, []))[1]
            if item is not None and item not in names:
                names.append(item)
    return found


def benchmark_blocks(items: DataFrame, window: int, max_bytes: int, id_col: str, text_col: str) -> list[Broadcast]:
    """Patterns of the items in blocks of about ``max_bytes`` of text at most."""
    rows = items.select(F.col(id_col).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // max_bytes) or 1
    out = []
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        found = patterns([(r["item"], r["text"]) for r in part.toLocalIterator()], window)
        out.append(items.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, found)))
    return out


_AUTOMATA: dict[str, object] = {}


def _automaton(block: Broadcast):
    """Built once for each worker process."""
    import ahocorasick

    name, found = block.value
    if name not in _AUTOMATA:
        machine = ahocorasick.Automaton()
        for key, (size, items) in found.items():
            machine.add_word(key, (len(key), size, items))
        if len(machine):
            machine.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[name] = machine
    return _AUTOMATA[name]


def _scan(machine, text: str | None) -> tuple[int, list[tuple[int, int, int, int]], set]:
    """Number of words; hit runs, merged: first word, end word, first and end place in the original; items."""
    words = words_of(text)
    if not len(machine):
        return len(words), [], set()
    normal = " " + b" ".join(words).decode("latin-1") + " "
    hits, items, begins = [], set(), None
    for end, (length, size, names) in machine.iter(normal):
        if begins is None:
            begins = np.cumsum([0, *(len(w) + 1 for w in words)]).tolist()
        first = bisect.bisect_left(begins, end - length + 1)
        hits.append((first, first + size, 0, 0))
        items.update(names)
    return len(words), _placed(text, merged(hits)), items


def merged(runs: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Runs of words without overlaps; runs that touch become one."""
    out: list[tuple[int, int, int, int]] = []
    for run in sorted(runs):
        if out and run[0] <= out[-1][1]:
            last = max(out[-1], run, key=lambda x: x[1])
            out[-1] = (out[-1][0], last[1], out[-1][2], last[3])
        else:
            out.append(run)
    return out


def _placed(text: str, runs: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The runs with their places in the original text, in characters."""
    if not runs:
        return []
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw.translate(_TO_WORDS))]
    out = []
    for first, last, _, _ in runs:
        begin = len(raw[: places[first][0]].decode())
        out.append((first, last, begin, begin + len(raw[places[first][0] : places[last - 1][1]].decode())))
    return out


_RUNS = "array<struct<word: int, end_word: int, first: int, last: int>>"
_NAMES = ("word", "end_word", "first", "last")


def _scan_block(rows: DataFrame, block: Broadcast, item_type: str) -> DataFrame:
    """rid, id, n_words, runs, items of every row."""
    schema = StructType.fromDDL(f"rid long, id long, n_words long, runs {_RUNS}, items array<{item_type}>")
    arrow = to_arrow_schema(schema)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(block)
        for batch in slices(batches):
            found = [_scan(machine, text) for text in batch.column("text").to_pylist()]
            columns = [
                pa.array([x[0] for x in found], pa.int64()),
                pa.array([[dict(zip(_NAMES, run, strict=True)) for run in x[1]] for x in found], arrow.field("runs").type),
                pa.array([list(x[2]) for x in found], arrow.field("items").type),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("id"), *columns], schema=arrow)

    return rows.mapInArrow(look, schema)


def scan(
    docs: DataFrame, items: DataFrame, *, window: int = 10, max_bytes: int = 8 << 20,
    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit, items (array of item ids), spans (hit places in the original text).

    With several blocks the documents are numbered in a written table and each
    block's hits are written; a document's hits then meet by its number.
    """
    spark = docs.sparkSession
    blocks = benchmark_blocks(items, window, max_bytes, item_id_col, item_text_col)
    item_type = items.select(item_id_col).schema[0].dataType.simpleString()
    rows = narrow(docs, id_col, text_col).withColumn("rid", F.monotonically_increasing_id() if len(blocks) > 1 else F.lit(0).cast("long"))
    if len(blocks) == 1:
        found = _scan_block(rows, blocks[0], item_type)
    else:
        rows = storage.write_then_read(rows, storage.fresh_folder(spark, "numbered"))
        parts = [
            storage.write_then_read(_scan_block(rows, block, item_type), storage.fresh_folder(spark, "hits")) for block in blocks
        ]

        @F.pandas_udf(_RUNS)
        def merge(runs: pd.Series) -> pd.Series:
            each = ([tuple(run[n] for n in _NAMES) for run in x] for x in runs)
            return pd.Series([[dict(zip(_NAMES, run, strict=True)) for run in merged(x)] for x in each])

        together = reduce(DataFrame.unionByName, parts).groupBy("rid", "id", "n_words").agg(
            F.flatten(F.collect_list("runs")).alias("runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
        )
        found = together.withColumn("runs", merge("runs"))
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, run: n + run["end_word"] - run["word"])
    spans = F.transform("runs", lambda run: F.struct(run["first"].alias("first"), run["last"].alias("last")))
    return found.select(F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), "items", spans.alias("spans"))


def drop_contaminated(
    docs: DataFrame, items: DataFrame, *, window: int = 10, max_bytes: int = 8 << 20, text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The documents without a hit, their columns as they were; the blocks filter one after the other."""
    ship(docs.sparkSession)
    for block in benchmark_blocks(items, window, max_bytes, item_id_col, item_text_col):
        docs = docs.where(~_is_hit(block, text_col))
    return docs


def _is_hit(block: Broadcast, text_col: str) -> Column:
    @F.pandas_udf("boolean")
    def hit(texts: pd.Series) -> pd.Series:
        machine = _automaton(block)
        return pd.Series([bool(_scan(machine, text)[1]) for text in texts], dtype=bool)

    return hit(F.col(text_col))


