"""Operator 13: resampling of documents towards a target distribution of hashed n-grams.

Words are runs of digits, ASCII letters (lower-cased) and bytes beyond ASCII. Every
run of one to ``grams`` successive words, joined by one space, is a feature; its
bucket is its CRC-32 modulo the number of buckets.

The distinct words of a piece of text, with a delimiter on either side, are the
dictionary of one Aho-Corasick automaton; each carries the CRC-32 and the length of
its word. One scan of the piece emits these payloads in the order of the words. The
CRC of a longer feature follows from the payloads next to each other (the CRC of
what stands before, shifted by the length of what follows), so no n-gram is ever
spelled or hashed. A piece is bounded in bytes and so is its dictionary, whatever
the vocabulary of the corpus.

Documents' buckets are written once; counting and scoring both read them. A task
counts into one array, so each sends at most one row a bucket to the sum. The gains
of the buckets, one number each, are all that reaches the driver and is broadcast.
The draw takes the highest scores (weight plus a Gumbel number from the id) by a
range sort whose rows are numbered by the sizes of the parts before.

Nulls and ties: a null or wordless text has no features and weight 0; a null id takes
the noise of the text ``null`` in place of the id and comes after all others of its
score; equal scores go to the smaller id, rows equal in both to the earlier written.
Repeated rows are judged one by one. A very long text is read in pieces and its
features are composed across them. Columns other than the two named are not read.
Empty tables count nothing: an empty target makes every gain that of t = 0.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cleargrain.llm.common import ASCII_LOWER, narrow, slices
from cleargrain.llm.words import ALPHANUMERIC
from cleargrain.operators.numbering import number, place
from cleargrain.plans import storage

#: Bytes of text under one automaton.
PIECE = 1 << 20
_NORMAL = bytes(ASCII_LOWER[b] if ALPHANUMERIC[b] else 0x20 for b in range(256))
_POLYNOMIAL = 0xEDB88320


def _times(rows: np.ndarray) -> np.ndarray:
    """Tables of a linear map over 32 bits from its images of the single bits: one of 256 entries a byte."""
    out = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for bit in range(8):
            held = (np.arange(256) >> bit & 1).astype(bool)
            out[byte, held] ^= rows[8 * byte + bit]
    return out


def _apply(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return tables[0, x & 255] ^ tables[1, x >> 8 & 255] ^ tables[2, x >> 16 & 255] ^ tables[3, x >> 24]


@lru_cache(maxsize=1)
def _shifts() -> tuple[np.ndarray, list[np.ndarray]]:
    """Maps of a CRC over 0 to 63 bytes that follow, and over 64, 128, 256, ... of them."""
    images = np.uint32(1) << np.arange(32, dtype=np.uint32)
    short = []
    for _ in range(64):
        short.append(_times(images))
        for _ in range(8):
            images = np.where(images & 1, images >> 1 ^ np.uint32(_POLYNOMIAL), images >> 1).astype(np.uint32)
    doubled = []
    for _ in range(25):
        doubled.append(_times(images))
        images = _apply(doubled[-1], images)
    return np.array(short), doubled


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRCs' share once ``length`` bytes follow: ``crc(a + b) == shifted(crc(a), len(b)) ^ crc(b)``."""
    short, doubled = _shifts()
    flat, low = short.reshape(-1), (length & 63) * 1024
    out = flat[low + (crc & 255)] ^ flat[low + 256 + (crc >> 8 & 255)] ^ flat[low + 512 + (crc >> 16 & 255)] ^ flat[low + 768 + (crc >> 24)]
    high = length >> 6
    for i, tables in enumerate(doubled if high.any() else ()):
        rows = np.flatnonzero(high >> i & 1)
        out[rows] = _apply(tables, out[rows])
    return out


def _dictionary(words: set[bytes]):
    """The automaton over delimited words; bytes are spelled as Latin-1. The payload is the length above the CRC."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for word in words:
        machine.add_word(f" {word.decode('latin-1')} ", len(word) << 32 | zlib.crc32(word))
    machine.make_automaton()
    return machine


def payloads(normal: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC, length and end place of every word of text in which delimiters are spaces; it begins and ends with one."""
    found, first = [], 0
    while first < len(normal) - 1:
        last = len(normal) if len(normal) - first <= PIECE else normal.rfind(b" ", first + 1, first + PIECE) + 1
        if not last:  # a word longer than a piece
            last = normal.index(b" ", first + 1) + 1
        part = normal[first:last]
        if words := set(part.split()):
            hits = np.fromiter(chain.from_iterable(_dictionary(words).iter(part.decode("latin-1"))), np.int64).reshape(-1, 2)
            hits[:, 0] += first
            found.append(hits)
        first = last - 1  # the delimiter belongs to both
    hits = np.concatenate(found) if found else np.empty((0, 2), np.int64)
    return (hits[:, 1] & 0xFFFFFFFF).astype(np.uint32), hits[:, 1] >> 32, hits[:, 0]


def feature_buckets(texts: pa.Array, grams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, features of each text, and the features' buckets, text after text."""
    raw = [x.encode() for x in texts.to_pylist()]
    normal = (b" " + b" ".join(raw) + b" ").translate(_NORMAL)
    crc, length, end = payloads(normal)
    edges = np.cumsum([0, *(len(x) + 1 for x in raw)])
    places = np.searchsorted(end, edges, side="right")
    words = np.diff(places)
    owner = np.repeat(np.arange(len(raw)), words)
    spaced = shifted(np.full(len(crc), zlib.crc32(b" "), np.uint32), length) ^ crc
    kept, owners, now = [crc], [owner], crc
    for n in range(1, min(grams, len(crc))):
        now = shifted(now[:-1], length[n:] + 1) ^ spaced[n:]
        whole = owner[: len(now)] == owner[n:]
        kept.append(now[whole])
        owners.append(owner[: len(now)][whole])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return words, np.bincount(owner, minlength=len(raw)), (np.concatenate(kept) % buckets).astype(np.int32)[order]


def features(docs: DataFrame, *, grams: int = 3, buckets: int = 10_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_features, and the features' buckets (repeats counted, in no stated order)."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, counts, found = feature_buckets(batch.column("text"), grams, buckets)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(found))
            columns = [batch.column("id"), pa.array(words, pa.int64()), pa.array(counts, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_features", "buckets"])

    return narrow(docs, id_col, text_col).mapInArrow(name, "id long, n_words long, n_features long, buckets array<int>")


def histogram(found: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket, over all documents; one array of ``buckets`` numbers, whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("buckets").flatten().to_numpy(), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in found.select("buckets").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares of each bucket, floored."""
    buckets = len(source)
    all_source, all_target = float(int(source.sum()) + buckets), float(int(target.sum()) + buckets)
    ratio = [(t + 1.0) * all_source / ((s + 1.0) * all_target) for s, t in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weighed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """id, n_words, n_features, weight: the sum of the gains of a document's features."""
    shared = found.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            ends = lists.offsets.to_numpy().astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(shared.value[lists.flatten().to_numpy()])])
            columns = [*(batch.column(c) for c in ("id", "n_words", "n_features")), pa.array(np.diff(sums[ends - ends[0]]))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_features", "weight"])

    return found.mapInArrow(weigh, "id long, n_words long, n_features long, weight long")


def gumbel(seed: int, key: Column) -> Column:
    """Thousandths of a Gumbel number, floored, from the first 32 bits of the sha256 of ``seed:key``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    drawn = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296)))


def resample(
    docs: DataFrame, target: DataFrame, *, percent: int = 5, min_words: int = 20, grams: int = 3, buckets: int = 10_000, seed: int = 42,
    id_col: str = "doc_id", text_col: str = "text", target_id_col: str = "item_id", target_text_col: str = "text",
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null where it isn't drawn.

    Of the documents with ``min_words`` words or more, ``percent`` in a hundred are drawn.
    """
    spark = docs.sparkSession
    folder = storage.fresh_folder(spark, "buckets")
    found = storage.write_then_read(features(docs, grams=grams, buckets=buckets, id_col=id_col, text_col=text_col), folder)
    aimed = features(target, grams=grams, buckets=buckets, id_col=target_id_col, text_col=target_text_col)
    gain = gains(histogram(found, buckets), histogram(aimed, buckets))
    scored = weighed(found, gain).withColumn("score", F.col("weight") + gumbel(seed, F.col("id")))
    row = F.monotonically_increasing_id()
    scored = storage.write_then_read(scored.withColumn("row", row), storage.fresh_folder(spark, "weights"))
    storage.discard(spark, folder)
    eligible = scored.where(F.col("n_words") >= min_words)
    drawn = eligible.count() * percent // 100
    ordered = eligible.select("id", "n_features", "weight", "score", (-F.col("score")).alias("down"), F.col("id").isNull().alias("no_id"), "row")
    placed = storage.write_then_read(place(ordered, ["down", "no_id", "id", "row"]), storage.fresh_folder(spark, "ranked"))
    ranked = number(placed, [], "rank").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    columns = [F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(rest.select(*columns))
