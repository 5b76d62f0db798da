"""Operator 11: periodic runs of words by recompression.

A run is a stretch of words with smallest period q, at least two periods and
``min_length`` words long, that no neighbouring word extends.

The words of many texts lie one after the other, a separator of its own after each.
Recompression turns them into a run-length grammar, level by level: a block of equal
symbols becomes one symbol, then every pair of a left and a right symbol becomes one,
where a hash of the level splits the symbols into left and right. Equal stretches are
parsed alike but for their ends, so the grammar answers how far two places agree: up
the levels while both places begin a node, down again where nodes differ, a block in
one step. The answers are exact, for all places asked at once, forwards and backwards.

A run with period p holds two neighbouring multiples of p that agree over a period.
Such pairs on the harmonic grid (all p up to half a text) are candidates where three
words agree on one side, which every long enough run has; the grammar then extends
them exactly. The same stretch found with several periods keeps the smallest.

Nulls and ties: a null or wordless text has no runs; repeated rows are judged one by
one. Runs are sorted by start, then period. A very long text is a step of its own
whose memory is a few dozen times its bytes, the grid taken in parts of bounded
size. Columns other than the two named are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from cleargrain.llm.common import mix, narrow, ranges, slices

#: Pairs of the grid that are looked at together.
GRID = 1 << 20
#: Words that agree next to a candidate, on one side at least.
CLOSE = 3
_PLACES = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


class Grammar:
    """A run-length grammar of one sequence of symbols, and the places at which it agrees with itself.

    The nodes of all levels lie in one array, level after level, a mark at both ends of
    each. ``behind`` and ``ahead`` count a block's nodes up to and from a node of it.
    """

    def __init__(self, symbols: np.ndarray):
        now, lengths = symbols.astype(np.int64), np.ones(len(symbols), np.int64)
        fresh = int(now.max()) + 1 if len(now) else 0
        levels: list[dict[str, np.ndarray]] = []
        still = 0
        while len(now) > 1 and still < 8:
            for parsed in (self._blocks, self._pairs):
                begins, names = parsed(now, fresh, len(levels))
                if len(begins) == len(now):
                    still += 1
                    continue
                still, fresh = 0, max(fresh, int(names.max()) + 1)
                levels.append({"symbol": now, "length": lengths, "begins": begins, "block": np.full(len(now), parsed == self._blocks)})
                now, lengths = names, np.add.reduceat(lengths, begins)
        levels.append({"symbol": now, "length": lengths, "begins": np.arange(len(now)), "block": np.zeros(len(now), bool)})
        self.levels = len(levels)
        self._join(levels)

    @staticmethod
    def _blocks(now: np.ndarray, fresh: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """First nodes of blocks of equal symbols, and the symbol of each block."""
        begins = np.flatnonzero(np.concatenate([[True], now[1:] != now[:-1]]))
        counts = np.diff(begins, append=len(now))
        names = now[begins].copy()
        if len(several := np.flatnonzero(counts > 1)):
            keys = names[several] * (int(counts.max()) + 1) + counts[several]
            names[several] = fresh + np.unique(keys, return_inverse=True)[1]
        return begins, names

    @staticmethod
    def _pairs(now: np.ndarray, fresh: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for pairs of a left and a right symbol."""
        is_left = (mix(now.astype(np.uint64) + np.uint64((level + 1) << 40)) & np.uint64(1)).astype(bool)
        second = np.concatenate([[False], is_left[:-1] & ~is_left[1:]])
        begins = np.flatnonzero(~second)
        names = now[begins].copy()
        if len(paired := np.flatnonzero(np.diff(begins, append=len(now)) > 1)):
            keys = names[paired] * fresh + now[begins[paired] + 1]
            names[paired] = fresh + np.unique(keys, return_inverse=True)[1]
        return begins, names

    def _join(self, levels: list[dict[str, np.ndarray]]) -> None:
        sizes = [len(x["symbol"]) + 2 for x in levels]
        offsets = np.cumsum([0, *sizes])
        total = int(offsets[-1])
        self.symbol, self.length = np.zeros(total, np.int64), np.zeros(total, np.int64)
        self.parent, self.child = np.zeros(total, np.int64), np.zeros(total, np.int64)
        self.behind, self.ahead = np.ones(total, np.int32), np.ones(total, np.int32)
        self.is_first, self.is_last = np.zeros(total, bool), np.zeros(total, bool)
        for k, x in enumerate(levels):
            count, at = len(x["symbol"]), int(offsets[k]) + 1
            own = slice(at, at + count)
            self.symbol[own], self.length[own] = x["symbol"], x["length"]
            self.symbol[at - 1], self.symbol[at + count] = -1, -2  # the marks differ from all and from each other
            if k + 1 < len(levels):
                begins, up = x["begins"], int(offsets[k + 1]) + 1
                counts = np.diff(begins, append=count)
                self.parent[own] = np.repeat(np.arange(up, up + len(begins)), counts)
                self.is_first[at + begins] = True
                self.is_last[at + begins + counts - 1] = True
                self.child[up : up + len(begins)] = at + begins
                self.child[up - 1], self.child[up + len(begins)] = at - 1, at + count
                if x["block"][0]:
                    place = np.arange(count) - np.repeat(begins, counts)
                    self.behind[own], self.ahead[own] = place + 1, np.repeat(counts, counts) - place

    def agree(self, left: np.ndarray, right: np.ndarray, *, back: bool = False) -> np.ndarray:
        """How many symbols agree from two places on; backwards: up to and with them."""
        a, b = left + 1, right + 1
        total, level = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        rising, rows = np.ones(len(a), bool), np.arange(len(a))
        edge, room, way = (self.is_last, self.behind, -1) if back else (self.is_first, self.ahead, 1)
        while len(rows):
            equal = self.symbol[a] == self.symbol[b]
            up = equal & rising & edge[a] & edge[b]
            on = equal & ~up
            down = ~equal
            rising &= ~down
            steps = np.minimum(room[a[on]], room[b[on]])
            total[rows[on]] += steps * self.length[a[on]]
            a[on] += way * steps
            b[on] += way * steps
            a[up], b[up] = self.parent[a[up]], self.parent[b[up]]
            if back:  # the last child stands before the first child of the next node
                a[down], b[down] = self.child[a[down] + 1] - 1, self.child[b[down] + 1] - 1
            else:
                a[down], b[down] = self.child[a[down]], self.child[b[down]]
            level += up
            level -= down
            if (ended := level < 0).any():
                open_ = ~ended
                a, b, level, rising, rows = a[open_], b[open_], level[open_], rising[open_], rows[open_]
        return total


def _grid(counts: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Place and period of neighbouring multiples of every period up to half a text, in parts of about GRID pairs."""
    halves = counts // 2
    text = np.repeat(np.arange(len(counts)), halves)
    period = np.arange(len(text)) - np.repeat(np.cumsum(halves) - halves, halves) + 1
    pairs = (counts[text] - 1) // period
    ends, first = np.cumsum(pairs), 0
    while first < len(text):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + GRID, side="right")))
        own = slice(first, last)
        each = np.repeat(period[own], pairs[own])
        turn = ranges(np.zeros(last - first, np.int64), pairs[own])
        yield np.repeat(starts[text[own]], pairs[own]) + turn * each, each
        first = last


def _candidates(symbols: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods of the grid at which CLOSE words agree with those a period on, from the place or before it."""
    close = np.zeros(len(symbols) + CLOSE, np.uint64)
    for i, factor in enumerate(_PLACES):
        close[CLOSE : len(symbols) + CLOSE - i] += symbols[i:].astype(np.uint64) * factor  # from a place on
    close = mix(close)
    places, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for place, period in _grid(counts, starts):
        hit = np.flatnonzero((close[place + CLOSE] == close[place + period + CLOSE]) | (close[place] == close[place + period]))
        places.append(place[hit])
        periods.append(period[hit])
    return np.concatenate(places), np.concatenate(periods)


def find_runs(symbols: np.ndarray, counts: np.ndarray, min_length: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of all runs of texts of ``counts`` symbols each, sorted.

    ``symbols`` are small numbers, text after text without separators. ``min_length`` is
    at least 12: below it a run could agree in fewer than CLOSE words on either side.
    """
    if min_length < 4 * CLOSE:
        raise ValueError(f"Runs of fewer than {4 * CLOSE} words are not found")
    texts, nothing = np.flatnonzero(counts >= min_length), tuple(np.empty(0, np.int64) for _ in range(4))
    if not len(texts):
        return nothing
    sizes = counts[texts]
    before = np.cumsum(counts) - counts
    starts = np.cumsum(sizes + 1) - sizes - 1
    whole = np.full(int((sizes + 1).sum()), 0, np.int64)
    top = int(symbols.max()) + 1 if len(symbols) else 0
    whole[starts + sizes] = top + np.arange(len(texts))
    whole[ranges(starts, sizes)] = symbols[ranges(before[texts], sizes)]
    place, period = _candidates(whole, sizes, starts)
    if not len(place):
        return nothing
    grammar = Grammar(whole)
    ahead = grammar.agree(place, place + period)
    back = np.zeros(len(place), np.int64)
    inner = np.flatnonzero(place > 0)
    back[inner] = grammar.agree(place[inner] - 1, place[inner] + period[inner] - 1, back=True)
    start, length = place - back, period + ahead + back
    keep = np.flatnonzero(length >= np.maximum(min_length, 2 * period))
    start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])  # the smallest period of a stretch
    start, length, period = start[new], length[new], period[new]
    owner = np.searchsorted(starts, start, side="right") - 1
    order = np.lexsort((period, start))
    return texts[owner][order], (start - starts[owner])[order], length[order], period[order]


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, as bytes."""
    return text.encode().split()


_RUNS = "array<struct<start: long, length: long, period: long>>"


def periodic_runs(docs: DataFrame, *, min_length: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (sorted by start and period), and collapsed: the words that stay, joined by one space.

    Of every run the first period stays; a word goes if any run holds it behind its first period.
    """
    arrow = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [words_of(x) for x in batch.column("text").to_pylist()]
            counts = np.fromiter(map(len, words), np.int64, len(words))
            every = np.empty(int(counts.sum()), object)
            every[:] = [w for text in words for w in text]
            text, start, length, period = find_runs(pd.factorize(every)[0], counts, min_length)
            gone = np.zeros(len(every) + 1, np.int64)
            base = (np.cumsum(counts) - counts)[text] + start
            np.add.at(gone, base + period, 1)
            np.add.at(gone, base + length, -1)
            stays = np.cumsum(gone)[:-1] == 0
            collapsed, first = [], 0
            for n, own in zip(counts.tolist(), words, strict=True):
                kept = stays[first : first + n]
                collapsed.append(b" ".join(own if kept.all() else [w for w, k in zip(own, kept.tolist(), strict=True) if k]).decode())
                first += n
            edges = np.searchsorted(text, np.arange(len(words) + 1))
            runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), runs).cast(arrow)
            columns = [batch.column("id"), pa.array(counts), lists, pa.array(collapsed, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    return narrow(docs, id_col, text_col).mapInArrow(find, f"doc_id long, n_words long, runs {_RUNS}, collapsed string")
