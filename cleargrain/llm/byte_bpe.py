"""Operator 12: byte-level BPE, with pre-tokenisation as a scan instead of a pattern.

The pattern (contractions; letters, numbers or other signs with a space before
them; white space) is a small automaton over the classes of code points:

* An array gives the class of every code point. A shifted comparison adds what the
  pattern looks ahead for: whether a contraction follows an apostrophe, and whether
  white space is the last before something else.
* Each class is a function from state to state. Functions compose associatively,
  so a slice of texts is cut into equal rows: every row composes its functions, the
  rows' compositions are scanned in a logarithmic number of steps, and every row
  then runs from its true state, all rows at once. The first code point of a text
  has a constant function, so texts need no rows of their own.

The slices between the boundaries are looked up by their bytes; only new ones are
merged, all new ones of a step together, each by its lowest ranked, leftmost pair.
Tokens keep the place of their first byte, so any byte range of a text can be
decoded by itself, from its tokens alone.

Nulls and ties: a null text is empty and has no tokens; a null id stays null;
repeated rows are encoded one by one. A very long text is one step of its own whose
memory is a few dozen times its bytes; a very long slice (text without a border) is
merged with a heap. Columns other than the two named are not read. An empty table
gives no rows.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleargrain.llm.common import mix, narrow, ranges, slices
from cleargrain.llm.words import buffers

#: Bytes of slices and slices that a worker knows; beyond either it starts anew.
KNOWN_BYTES = 16 << 20
KNOWN_SLICES = 1 << 18
#: Slices of more bytes are merged one by one with a heap.
LONG_SLICE = 192
#: Code points in a row of the scan.
ROW = 512

# Classes of code points.
LETTER, NUMBER, OTHER, SHORT, LONG, WHITE, LAST_WHITE, LAST_SPACE = range(8)
CLASSES = 8
# States: a new match begins, inside letters, numbers, others, after the space that belongs to the next
# match, one or two letters left of a contraction, inside white space.
FRESH, LETTERS, NUMBERS, OTHERS, SPACE, ONE_LEFT, TWO_LEFT, WHITES = range(8)

# Letters and numbers of Unicode 16.0, which unicodedata may not know yet.
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
)
WHITE_SPACE = (
    (0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F),
    (0x205F, 0x205F), (0x3000, 0x3000),
)


@lru_cache(maxsize=1)
def code_point_classes() -> np.ndarray:
    """LETTER, NUMBER, WHITE or OTHER of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    for spans, kind in ((NEW_LETTERS, LETTER), (NEW_NUMBERS, NUMBER), (WHITE_SPACE, WHITE)):
        for first, last in spans:
            out[first : last + 1] = kind
    return out


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The state after a code point, and whether a match begins there."""
    if kind in (WHITE, LAST_WHITE, LAST_SPACE):
        return {WHITE: WHITES, LAST_WHITE: FRESH, LAST_SPACE: SPACE}[kind], kind != WHITE or state != WHITES
    if state in (ONE_LEFT, TWO_LEFT):
        return (FRESH if state == ONE_LEFT else ONE_LEFT), False
    joins = state == SPACE or state == {LETTER: LETTERS, NUMBER: NUMBERS}.get(kind, OTHERS)
    if kind in (SHORT, LONG) and not joins:
        return (ONE_LEFT if kind == SHORT else TWO_LEFT), True
    return {LETTER: LETTERS, NUMBER: NUMBERS}.get(kind, OTHERS), not joins


@lru_cache(maxsize=1)
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """next and begins by (state, class), the class's function, compositions, and the state each function leads FRESH to.

    Classes from CLASSES on are the first code points of texts. Functions are numbered;
    function 0 changes nothing. All compositions of the classes' functions are found once.
    """
    states = range(8)
    steps = [[_step(s, c) for s in states] for c in range(CLASSES)]
    steps += [[_step(FRESH, c)] * 8 for c in range(CLASSES)]
    following = np.array([[x[0] for x in row] for row in steps], np.uint8).T.copy()
    begins = np.array([[x[1] for x in row] for row in steps], bool).T.copy()
    begins[:, CLASSES:] = True
    functions = [tuple(states), *dict.fromkeys(tuple(x[0] for x in row) for row in steps)]
    numbers, done = {f: i for i, f in enumerate(functions)}, 0
    generators = functions[1:]
    while done < len(functions):
        for g in generators:
            both = tuple(g[x] for x in functions[done])
            if both not in numbers:
                numbers[both] = len(functions)
                functions.append(both)
        done += 1
    table = np.array([[numbers[tuple(g[x] for x in f)] for g in functions] for f in functions], np.uint16)
    of_class = np.array([numbers[tuple(x[0] for x in row)] for row in steps], np.uint16)
    return following, begins, of_class, table, np.array([f[FRESH] for f in functions], np.uint8)


def classes_of(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The class of each code point of texts that begin at ``first``, with what follows it taken in."""
    kinds = code_point_classes()[points]
    last = np.zeros(len(points) + 2, bool)  # nothing of the same text follows
    last[first[first > 0] - 1] = True
    last[len(points) - 1] = True
    white = kinds == WHITE
    solid = np.append(~white[1:], False) & ~last[: len(points)]
    kinds[white & solid] = LAST_WHITE
    kinds[white & solid & (points == 0x20)] = LAST_SPACE
    marks = np.flatnonzero((points == 0x27) & ~last[: len(points)])
    if len(marks):
        ahead = np.append(points, [0, 0])
        one, two = ahead[marks + 1], np.where(last[marks + 1], 0, ahead[marks + 2])
        kinds[marks[np.isin(one, [ord(x) for x in "stmd"])]] = SHORT
        pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
        kinds[marks[np.logical_or.reduce([(one == a) & (two == b) for a, b in pairs])]] = LONG
    kinds[first[first < len(points)]] += CLASSES
    return kinds


def scan(kinds: np.ndarray) -> np.ndarray:
    """Whether a match begins at each code point."""
    following, begins, of_class, table, from_fresh = _automaton()
    rows = -(-len(kinds) // ROW)
    padded = np.full(rows * ROW, CLASSES + OTHER, np.uint8)
    padded[: len(kinds)] = kinds
    columns = np.ascontiguousarray(padded.reshape(rows, ROW).T)
    whole = np.zeros(rows, np.uint16)
    for column in of_class[columns]:
        whole = table[whole, column]
    before, reach = np.concatenate([[np.uint16(0)], whole[:-1]]), 1  # the functions of all rows before, composed
    while reach < rows:
        before[reach:] = table[before[:-reach], before[reach:]]
        reach *= 2
    state, out = from_fresh[before], np.empty(columns.shape, bool)
    for i, column in enumerate(columns):
        out[i] = begins[state, column]
        state = following[state, column]
    return out.T.reshape(-1)[: len(kinds)]


def boundaries(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of all matches in texts of UTF-8 bytes that lie one after the other."""
    if not len(data):
        return np.empty(0, np.int64)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    places = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(places, offsets[:-1][offsets[:-1] < len(data)])
    return places[scan(classes_of(points, np.unique(first)))]


_random = np.random.default_rng(12)
_BYTES = _random.integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_ODD = np.uint64(int(_random.integers(1 << 62, 1 << 63)) | 1)


def _keys(data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every slice."""
    powers = np.full(int(lengths.max()), _ODD, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)[np.arange(len(data)) - np.repeat(begins, lengths)]
    first, second = (mix(np.add.reduceat(table[data] * powers, begins) + lengths.astype(np.uint64)) for table in _BYTES)
    return first, second


class Pairs:
    """The id that two neighbouring ids merge into: an open-addressed table."""

    NONE = np.int64((1 << 62) - 1)

    def __init__(self, ranks: dict[bytes, int]):
        self._step = max(ranks.values()) + 1
        found = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    found[left * self._step + right] = rank
        bits = max(8, (4 * len(found)).bit_length())
        self._shift, self._last = np.uint64(64 - bits), (1 << bits) - 1
        self._keys, self._ids = np.full(1 << bits, -1, np.int64), np.full(1 << bits, self.NONE, np.int64)
        keys, ids = np.fromiter(found.keys(), np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found))
        slots = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self._keys[slots] < 0)
            at, one = np.unique(slots[free], return_index=True)
            self._keys[at], self._ids[at] = keys[free[one]], ids[free[one]]
            stay = np.ones(len(keys), bool)
            stay[free[one]] = False
            keys, ids, slots = keys[stay], ids[stay], (slots[stay] + 1) & self._last

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged id of each pair, or NONE."""
        keys = left * self._step + right
        slots = self._slots(keys)
        held, out = self._keys[slots], self._ids[slots]
        wait = np.flatnonzero((held != keys) & (held >= 0))
        out[(held != keys) & (held < 0)] = self.NONE
        slots = slots[wait]
        while len(wait):
            slots = (slots + 1) & self._last
            held, out[wait] = self._keys[slots], self._ids[slots]
            out[wait[held != keys[wait]]] = self.NONE
            again = (held != keys[wait]) & (held >= 0)
            wait, slots = wait[again], slots[again]
        return out


class ByteBPE:
    """One file of ranks: ids of whole texts, and texts of ids."""

    def __init__(self, path: str):
        rows = (line.split() for line in Path(path).read_bytes().splitlines() if line.strip())
        self._ranks = {base64.b64decode(token): int(rank) for token, rank in rows}
        self._pairs = Pairs(self._ranks)
        self._single = np.array([self._ranks[bytes([b])] for b in range(256)], np.int64)
        size = max(self._ranks.values()) + 1
        self.sizes = np.zeros(size, np.int64)
        for token, rank in self._ranks.items():
            self.sizes[rank] = len(token)
        self._places = np.cumsum(self.sizes) - self.sizes
        spelled = {rank: token for token, rank in self._ranks.items()}
        self._spelling = np.frombuffer(b"".join(spelled.get(i, b"") for i in range(size)), np.uint8)
        self.forget()

    def forget(self) -> None:
        """Drop the known slices; idle workers keep little memory."""
        self._known: dict[bytes, int] = {}
        self._known_bytes = self._used = 0
        self._flat = np.empty(1 << 16, np.int32)
        self._starts, self._counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def _merged_alone(self, piece: bytes) -> list[int]:
        """A long slice: a heap of pairs, lowest rank first and leftmost among equals, over a linked list."""
        ids = self._single[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        spelled = [bytes([b]) for b in piece]
        ranks, heap = self._ranks, []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(ids) and (rank := ranks.get(spelled[i] + spelled[j])) is not None:
                heapq.heappush(heap, (rank, i, spelled[i], spelled[j]))

        for i in range(len(ids)):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if spelled[i] != left or j >= len(ids) or spelled[j] != right:
                continue  # one of the two was merged meanwhile
            spelled[i], ids[i], spelled[j], after[i] = left + right, rank, b"", after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [ids[i] for i in range(len(ids)) if spelled[i]]

    def _merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all slices, one after the other, and how many each has: in every round each slice merges one pair."""
        counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = self._single[np.frombuffer(b"".join(pieces), np.uint8)]
        owner, none = np.arange(len(pieces)), Pairs.NONE
        ends = np.cumsum(counts)
        ranks = np.full(len(ids), none, np.int64)
        ranks[:-1] = self._pairs.find(ids[:-1], ids[1:])
        ranks[ends - 1] = none
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(owner):
            best = np.minimum.reduceat(ranks, ends - counts)
            if not (going := best != none).all():
                part = np.repeat(going, counts)
                done.append((owner[~going], counts[~going], ids[~part]))
                ids, ranks, owner, counts, best = ids[part], ranks[part], owner[going], counts[going], best[going]
                ends = np.cumsum(counts)
                if not len(owner):
                    break
            hits = np.flatnonzero(ranks == np.repeat(best, counts))
            hits = hits[np.searchsorted(hits, ends - counts)]  # the leftmost of each slice
            ids[hits] = best
            stay = np.ones(len(ids), bool)
            stay[hits + 1] = False
            ids, ranks, counts = ids[stay], ranks[stay], counts - 1
            ends = np.cumsum(counts)
            hits -= np.arange(len(hits))
            inner = hits[hits + 1 < ends]
            ranks[hits] = none
            ranks[inner] = self._pairs.find(ids[inner], ids[inner + 1])
            inner = hits[hits > ends - counts]
            ranks[inner - 1] = self._pairs.find(ids[inner - 1], ids[inner])
        owner, counts, ids = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(owner)
        starts = np.cumsum(counts) - counts
        return ids[ranges(starts[order], counts[order])], counts[order]

    def _learn(self, pieces: list[bytes]) -> None:
        """Put new slices into the known ones."""
        whole = [self._ranks.get(x) for x in pieces]
        kinds = ([i for i, (x, r) in enumerate(zip(pieces, whole, strict=True)) if r is None and (len(x) > LONG_SLICE) == long] for long in (False, True))
        short, long = kinds
        made: list[tuple[list[int], np.ndarray, np.ndarray]] = []
        ready = [i for i, r in enumerate(whole) if r is not None]
        made.append((ready, np.array([whole[i] for i in ready], np.int64), np.ones(len(ready), np.int64)))
        if short:
            made.append((short, *self._merged([pieces[i] for i in short])))
        for i in long:
            ids = self._merged_alone(pieces[i])
            made.append(([i], np.array(ids, np.int64), np.array([len(ids)])))
        for rows, ids, counts in made:
            while self._used + len(ids) > len(self._flat):
                self._flat = np.concatenate([self._flat, np.empty_like(self._flat)])
            self._flat[self._used : self._used + len(ids)] = ids
            first = len(self._starts)
            self._starts = np.concatenate([self._starts, self._used + np.cumsum(counts) - counts])
            self._counts = np.concatenate([self._counts, counts])
            self._used += len(ids)
            self._known.update(zip([pieces[i] for i in rows], range(first, first + len(rows)), strict=True))
        self._known_bytes += sum(map(len, pieces))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and how many each text has."""
        if self._known_bytes > KNOWN_BYTES or len(self._known) > KNOWN_SLICES:
            self.forget()
        data, offsets = buffers(texts)
        begins = boundaries(data, offsets)
        if not len(begins):
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        lengths = np.diff(begins, append=len(data))
        first, second = _keys(data, begins, lengths)
        _, one, which = np.unique(first, return_index=True, return_inverse=True)
        if (second != second[one][which]).any():  # two slices with one hash: compare the slices themselves
            one, which = np.arange(len(begins)), np.arange(len(begins))
        raw = data.tobytes()
        pieces = [raw[a : a + n] for a, n in zip(begins[one].tolist(), lengths[one].tolist(), strict=True)]
        if new := [x for x in dict.fromkeys(pieces) if x not in self._known]:
            self._learn(new)
        numbers = np.fromiter(map(self._known.__getitem__, pieces), np.int64, len(pieces))[which]
        counts = self._counts[numbers]
        before = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(begins, offsets)]
        return self._flat[ranges(self._starts[numbers], counts)], np.diff(before)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, one after the other."""
        return self._spelling[ranges(self._places[ids], self.sizes[ids])]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBPE:
    """One for each worker process and file; Spark keeps workers between tasks."""
    return ByteBPE(path)


def encode_documents(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, starts: the first byte of each token in the text, and the text's bytes at the end."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in slices(batches):
            ids, counts = bpe.encode(batch.column("text"))
            ends = np.cumsum(counts)
            places = np.concatenate([[0], np.cumsum(bpe.sizes[ids])])
            inside = ranges(ends - counts, counts + 1)  # each text's tokens and the place behind them
            starts = places[inside] - np.repeat(places[ends - counts], counts + 1)
            edges = np.concatenate([[0], ends])
            columns = [
                batch.column("id"),
                pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids, pa.int32())),
                pa.ListArray.from_arrays(pa.array(edges + np.arange(len(edges)), pa.int32()), pa.array(starts, pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "starts"])
        bpe.forget()

    return narrow(docs, id_col, text_col).mapInArrow(encode, "doc_id long, ids array<int>, starts array<int>")


def decode_documents(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, decoded: the texts' bytes, of whole rows of ``encode_documents`` or of ``byte_range``."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            ids = batch.column("ids").flatten().to_numpy()
            counts = np.diff(batch.column("ids").offsets.to_numpy().astype(np.int64))
            starts = batch.column("starts")
            last = starts.offsets.to_numpy().astype(np.int64) - starts.offsets[0].as_py()
            places = starts.flatten().to_numpy().astype(np.int64)
            sizes = places[last[1:] - 1] - places[last[:-1]]
            spelled = bpe.spell(ids)
            if (sizes != np.add.reduceat(np.append(bpe.sizes[ids], 0), np.cumsum(counts) - counts) * (counts > 0)).any():
                raise ValueError("Places and ids do not belong together")
            ends = np.concatenate([[0], np.cumsum(sizes)])
            whole = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(spelled)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), whole.cast(pa.binary())], names=["doc_id", "ids", "decoded"])

    return tokens.select("doc_id", "ids", "starts").mapInArrow(decode, "doc_id long, ids array<int>, decoded binary")


def byte_range(tokens: DataFrame, first: int, last: int) -> DataFrame:
    """The tokens that hold any byte from ``first`` to before ``last`` of their text, found by their places."""
    count = F.size("ids")
    low = F.size(F.filter("starts", lambda x: x <= first)) - 1  # the token that holds ``first``
    high = F.size(F.filter("starts", lambda x: x < last))
    begin, end = F.least(low, count), F.least(high, count)
    kept = F.greatest(end - begin, F.lit(0))
    return tokens.select("doc_id", F.slice("ids", begin + 1, kept).alias("ids"), F.slice("starts", begin + 1, kept + 1).alias("starts"))
