"""Operator 7: exact Jaccard join over word shingles with PartEnum signatures.

Sets are put in bands of nearly equal size. In a band, linked sets differ in at
most k elements (k follows from the threshold and the band). The element domain
is split by hash into first-level parts, so that some part differs in one element
at most, and each part into second-level parts; enumerating the second-level
parts but one gives signatures of which linked sets share at least one. A set
also takes part in the lower bands that hold smaller sets it can link with.

A signature over parts where both sets are empty says nothing. Bands with many
parts therefore have ``spare`` first-level parts more, about as many as come out
weak (with an empty signature): linked sets then agree on ``spare + 1`` parts, and
empty signatures are left out. Only a set with more weak parts than ``spare`` adds
the numbers of its weak parts as signatures.

Sets that are equal are one class from the start. Classes that share a signature
are candidates, each verified on its whole sets. A large group of candidates is
never paired out: in each turn every class is verified against a few pivots that
it shares a signature with, and signatures whose classes have become one component
are done. What is left (classes that share signatures and that no pivot connects)
is verified in full, so no link is lost; one side of a large signature is dealt over
several join keys there, so its pairs spread over tasks, though their number stays
the square of such a group. Sketches rule out most pairs before sets travel.
The component of a hot class is broadcast, so its rows stay where they are; members of
a hot signature meet by signature.

Nulls and ties: a null or wordless text has the empty set and links with nothing;
a text with fewer words than a shingle is one shingle as a whole; a component of
rows with null ids alone has a null id; rows with equal ids are judged by their
own texts. Other columns are not read. An empty table gives no rows. A very long
text is one set, held whole by its task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleargrain.llm import bloom
from cleargrain.llm.common import join_facts, mix, narrow, slices
from cleargrain.llm.components import components
from cleargrain.llm.words import NOT_SPACE, shingle_set, word_hashes
from cleargrain.plans import storage

#: Share of sampled signature rows from which a signature counts as hot; it bounds their number.
HOT_SHARE = 1 / 2048
_SAMPLE = 32
#: Partitions over which the rows of a hot signature are dealt.
SPREAD = 64
#: Classes of a signature that the others are verified against in a turn.
PIVOTS = 16
#: Classes of a signature, on one side, that a join in full compares with the others under one key.
DEAL = 512
#: Long integers of the small sketch.
WORDS = 8
#: Stands for a null id where ids are matched.
NO_ID = -(1 << 63)


class Bands:
    """Size bands and their parts for links with ``100 * common >= percent * union``."""

    def __init__(self, percent: int, ratio: float = 1.3):
        self._percent, self._ratio = percent, ratio
        self._tops: list[int] = []

    def of(self, size: int) -> list[int]:
        """The band of a size, and the lower bands with sizes it can link to."""
        tops = self._tops
        while not tops or tops[-1] < size:
            low = tops[-1] + 1 if tops else 1
            tops.append(max(low, int(low * self._ratio) - 1))
        band = int(np.searchsorted(tops, size))
        out = [band]
        while band and 100 * tops[band - 1] >= self._percent * size:
            band -= 1
            out.append(band)
        return out

    def parts(self, band: int) -> tuple[int, int, int]:
        """First-level parts, second-level parts of each, and spare parts."""
        top = self._tops[band]
        differ = (top + 100 * top // self._percent) * (100 - self._percent) // (100 + self._percent)
        if not differ:
            return 1, 1, 0
        if differ < 6:
            return differ // 2 + 1, 3, 0
        low, least, second, spare = self._tops[band - 1] + 1, differ // 2 + 1, 3 if differ < 12 else 2, 0
        for _ in range(4):  # as many as the parts that come out weak in most sets, within half of the others
            parts = least + spare
            weak = parts * min(1.0, second * math.exp(-low * (second - 1) / (parts * second)))
            spare = min(max(2, least // 2), math.ceil(weak + 2.5 * math.sqrt(weak)))
        return least + spare, second, spare


def signatures(elements: np.ndarray, bands: Bands) -> np.ndarray:
    """64-bit signatures of a set given as distinct hashes."""
    out, value = [], mix(elements ^ np.uint64(0x5851F42D4C957F2D))
    for band in bands.of(len(elements)):
        first, second, spare = bands.parts(band)
        cells = first * second
        cell = ((elements >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        held, begin = np.unique(cell[order], return_index=True)
        sums, counts = np.zeros(cells, np.uint64), np.bincount(cell, minlength=cells)
        sums[held] = np.add.reduceat(value[order], begin)
        sums, counts = sums.reshape(first, second), counts.reshape(first, second)
        if second > 1:  # all second-level parts but one
            sums, counts = sums.sum(1, keepdims=True) - sums, counts.sum(1, keepdims=True) - counts
        tags = np.arange(cells, dtype=np.uint64).reshape(first, second) + np.uint64(band << 32)
        every = mix(sums + mix(tags) + counts.astype(np.uint64))
        out.append(every[counts > 0])
        weak = np.flatnonzero((counts == 0).any(1))
        if len(weak) > spare:
            out.append(mix(mix(weak.astype(np.uint64) + np.uint64(band << 32)) ^ np.uint64(0x2545F4914F6CDD1D)))
    return np.concatenate(out)


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in slices(batches):
        hashes, _, _, first = word_hashes(batch.column("text"), NOT_SPACE)
        yield batch, [shingle_set(hashes[a:b], shingle) for a, b in zip(first[:-1], first[1:], strict=True)]


def _codes(sets: list[np.ndarray]) -> np.ndarray:
    """Two 64-bit hashes of each set; an empty set has zeros."""
    return np.array([[np.add.reduce(mix(x ^ np.uint64(seed))) for x in sets] for seed in (1, 2)], np.uint64).reshape(2, -1).view(np.int64)


def classed(rows: DataFrame, shingle: int) -> DataFrame:
    """id, n (set size), code and code2 (128 bits of the set)."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, shingle):
            codes, others = _codes(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(codes), pa.array(others)],
                names=["id", "n", "code", "code2"],
            )

    return rows.mapInArrow(name, "id long, n long, code long, code2 long")


def signed(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """sig, code: a row for each signature of each document."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for _, sets in _sets(batches, shingle):
            codes = _codes(sets)[0]
            found = [signatures(x, bands).view(np.int64) if len(x) else np.empty(0, np.int64) for x in sets]
            owners = np.repeat(codes, [len(x) for x in found])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(owners)], names=["sig", "code"])

    return rows.mapInArrow(sign, "sig long, code long")


def _shared(sorted_rows: DataFrame) -> DataFrame:
    """Of rows sorted by sig and code, one a distinct pair, without signatures of a single code unless they are hot."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[np.ndarray, np.ndarray, np.ndarray, bool] | None = None  # the row before, and whether it is out already
        for batch in batches:
            if not len(batch):
                continue
            sig, code, hot = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "code", "hot"))
            out_before = False
            if last is not None:
                sig, code, hot = (np.concatenate(x) for x in zip(last[:3], (sig, code, hot), strict=True))
                out_before = last[3]
            new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (code[1:] != code[:-1])])
            sig, code, hot = sig[new], code[new], hot[new].astype(bool)
            like_before = np.concatenate([[out_before], sig[1:] == sig[:-1]])
            like_next = np.concatenate([sig[1:] == sig[:-1], [False]])
            keep_rows = like_before | like_next | hot
            keep_rows[0] &= not out_before
            if keep_rows.any():
                yield pa.RecordBatch.from_arrays([pa.array(sig[keep_rows]), pa.array(code[keep_rows])], names=["sig", "code"])
            last = (sig[-1:], code[-1:], hot[-1:], bool(like_before[-1] | hot[-1]))

    return sorted_rows.mapInArrow(keep, "sig long, code long")


def _land(frame: DataFrame, purpose: str) -> DataFrame:
    return storage.write_then_read(frame, storage.fresh_folder(frame.sparkSession, purpose))


def memberships(rows: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """sig, node, n: the classes of every signature that several classes share.

    A signature that holds a large share of the rows, found on a sample, is known
    to be shared: its rows are dealt over SPREAD partitions. Fewer than
    1 / HOT_SHARE signatures can hold that share, which bounds the broadcast.
    """
    sample = signed(rows.where(f"pmod(xxhash64(id, text), {_SAMPLE}) = 0"), shingle, percent).distinct()
    sample = _land(sample.groupBy("sig").agg(F.count("*").alias("rows")), "sampled")
    least = (sample.agg(F.sum("rows")).first()[0] or 0) * HOT_SHARE
    hot = sample.where((F.col("rows") > 1) & (F.col("rows") > least)).select("sig", F.lit(True).alias("hot"))
    every = signed(rows, shingle, percent).join(F.broadcast(hot), "sig", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    salt = F.when(F.col("hot"), F.pmod("code", F.lit(SPREAD))).otherwise(F.lit(0))
    shared = _shared(every.repartition(F.col("sig"), salt).sortWithinPartitions("sig", "code"))
    return _land(shared.join(classes.select("code", "node", "n"), "code").select("sig", "node", "n"), "members")


def sets_of(rows: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """node, elements (sorted hashes as bytes), sketch and parities of the classes wanted.

    A class's set comes from the documents with its ``rep``. Texts stay in their
    task: a filter of the ids tells which ones to read.
    """
    held = bloom.holding(wanted.select(F.xxhash64(F.coalesce("rep", F.lit(NO_ID))).alias("h")))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = batch.filter(pa.array(bloom.held(held.value, batch.column("h").to_numpy())))
            for part, sets in _sets(iter([chosen]), shingle):
                del part
                codes, others = _codes(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(codes), pa.array(others), pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([x.tobytes() for x in sets], pa.binary()), pa.array([sketch(x) for x in sets], pa.binary()),
                        pa.array([parities(x).tolist() for x in sets], pa.list_(pa.int64())),
                    ],
                    names=["code", "code2", "n", "elements", "sketch", "words"],
                )

    keyed = rows.withColumn("h", F.xxhash64(F.coalesce("id", F.lit(NO_ID))))
    found = keyed.mapInArrow(pick, "code long, code2 long, n long, elements binary, sketch binary, words array<long>")
    columns = ("node", "elements", "sketch", "words")
    return found.join(wanted.drop("rep"), ["code", "code2", "n"]).select(*columns).dropDuplicates(["node"])


def sketch(elements: np.ndarray) -> bytes:
    """Parities of the elements over a power of two of cells, two cells an element or more."""
    cells = max(64, 1 << int(2 * len(elements) - 1).bit_length())
    counts = np.bincount((elements & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def parities(elements: np.ndarray) -> np.ndarray:
    """A sketch of fixed size, as WORDS long integers."""
    cells = (elements >> np.uint64(40)) & np.uint64(64 * WORDS - 1)
    counts = np.bincount(cells.astype(np.int64), minlength=64 * WORDS)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


def differ_at_least(a: bytes | pa.Buffer, b: bytes | pa.Buffer) -> int:
    """A lower bound of the elements by which two sketched sets differ: unequal parities."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _paired(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b, ...) with a column of both classes as left and right."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col(column).alias("left")), "a")
    return left.join(sets.select(F.col("node").alias("b"), F.col(column).alias("right")), "b")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, n, n2) whose whole sets link, as a and b.

    Sketches, a thirtieth of the sets' size, rule out most of the others first.
    """

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n").to_numpy() + batch.column("n2").to_numpy()
            most = sizes * (100 - percent) // (100 + percent)
            bounds = [differ_at_least(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column("left"), batch.column("right"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(np.array(bounds, np.int64) <= most))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sketched = _paired(pairs, sets, "sketch").select("a", "b", "n", "n2", "left", "right")
    close = _land(sketched.mapInArrow(near, "a long, b long"), "close")
    return _paired(close, sets, "elements").select("a", "b", "left", "right").mapInArrow(check, "a long, b long")


def _fit(percent: int):
    """Two sizes that can link."""
    return F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent


def _near(percent: int):
    """Parities that do not rule a link out."""
    unequal = sum((F.bit_count(F.col(f"w{i}").bitwiseXOR(F.col(f"v{i}"))) for i in range(WORDS)), F.lit(0))
    return unequal * (100 + percent) <= (F.col("n") + F.col("n2")) * (100 - percent)


def dealt(members: DataFrame, other: DataFrame) -> DataFrame:
    """Every member with every other of its signature, joined by (sig, deal) so that a large signature is many keys.

    A key has about DEAL members; the others go to each of their signature's keys.
    """
    deals = lambda many: F.ceil(F.col(many) / DEAL)
    left = members.withColumn("deal", F.pmod(F.xxhash64("node", "sig"), deals("many")))
    right = other.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), deals("among") - 1)))
    return left.join(right, ["sig", "deal"])


def links(members: DataFrame, sets: DataFrame, percent: int, max_turns: int = 6) -> DataFrame | None:
    """node and root for classes that link with others; None if no signature is shared.

    A turn verifies every class against about PIVOTS others of each of its
    signatures, those with the smallest hashes, so signatures of few classes are
    done in one. Turns go on while they connect much of what they could.
    """
    spark, found, root, before = members.sparkSession, None, None, None
    tested = spark.createDataFrame([], "a long, b long")
    for turn in range(max_turns + 1):
        now = members.select("sig", "node", "n").withColumn("root", F.col("node"))
        if root is not None:
            now = members.select("sig", "node", "n").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
        held = now.groupBy("sig", "root").agg(F.count("*").alias("c"))
        open_ = held.groupBy("sig").agg(F.count("*").alias("roots"), F.sum("c").alias("many"), F.sum(F.col("c") * F.col("c")).alias("same"))
        open_ = open_.where(f"roots > 1 and many > {PIVOTS if turn else 0}").select("sig", "many", "same")
        words = sets.select("node", *[F.col("words")[i].alias(f"w{i}") for i in range(WORDS)])
        members = _land(now.join(open_, "sig").join(words, "node"), "members")
        left = members.agg(F.sum(F.col("many") - F.col("same") / F.col("many")).alias("pairs"), F.count("*").alias("rows")).first()
        if not left["rows"]:
            break
        last = bool(turn) and (turn == max_turns or left["pairs"] <= PIVOTS * left["rows"] or left["pairs"] > 0.7 * before)
        before = left["pairs"]
        other = members.select(
            "sig", F.col("node").alias("b"), F.col("root").alias("root2"), F.col("n").alias("n2"), F.col("many").alias("among"),
            *[F.col(f"w{i}").alias(f"v{i}") for i in range(WORDS)],
        )
        if not last:
            place = F.shiftrightunsigned(F.xxhash64("b", F.lit(turn)), 1) / F.lit(float(1 << 63))
            other = other.where(place * F.col("among") < PIVOTS)
        can_link = (F.col("root") != F.col("root2")) & _fit(percent) & _near(percent)
        if last:
            pairs = dealt(members, other).where(can_link & (F.col("node") < F.col("b")))
        else:
            pairs = members.join(other.drop("among"), "sig").where(can_link)
        pairs = pairs.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"), "n", "n2").dropDuplicates(["a", "b"])
        pairs = _land(pairs.join(tested, ["a", "b"], "left_anti"), "candidates")
        tested = tested.unionByName(pairs.select("a", "b"))
        new = verified(pairs, sets, percent)
        found = _land(new if found is None else found.unionByName(new), "links")
        root = components(found)
        if last:
            break
    return root


def jaccard_components(
    docs: DataFrame, *, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest id that links reach."""
    rows = narrow(docs, id_col, text_col)
    table = _land(classed(rows, shingle), "classed")
    classes = table.where("n > 0").groupBy("code", "code2", "n").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = _land(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    members = memberships(rows, classes, shingle, percent)
    wanted = classes.drop("copies").join(members.select("node").distinct(), "node", "left_semi")
    root = links(members, _land(sets_of(rows, wanted, shingle), "sets"), percent)
    named = classes.withColumn("root", F.col("node"))
    if root is not None:
        named = classes.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
        best = named.groupBy("root").agg(F.min("rep").alias("component_id"))
        named = named.join(best, "root")
    else:
        named = named.withColumn("component_id", F.col("rep"))
    named = _land(named.select("code", "code2", "n", "component_id", "copies"), "named")
    full = table.where("n > 0").select("id", "n", "code", "code2")
    full = join_facts(full, named, ["code", "code2", "n"], "copies", table.count())
    empty = table.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return full.select("id", "n", "component_id").unionByName(empty).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, *, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each component, the one with the smallest id; columns as they were.

    Only rows that a filter of the dropped ids may hold are shuffled. Of rows with
    the same id as the one that stays, all stay.
    """
    found = jaccard_components(docs, shingle=shingle, percent=percent, id_col=id_col, text_col=text_col)
    dropped = _land(found.where("doc_id != component_id").select(F.col("doc_id").alias("rep")).distinct(), "dropped")
    held = bloom.holding(dropped.select(F.xxhash64("rep").alias("h")))
    key = F.col(id_col).cast("long")
    sure = docs.where(~bloom.maybe(held, F.xxhash64(F.coalesce(key, F.lit(NO_ID)))))
    unsure = docs.where(bloom.maybe(held, F.xxhash64(F.coalesce(key, F.lit(NO_ID)))))
    return sure.unionByName(unsure.join(dropped, key == dropped["rep"], "left_anti"))
