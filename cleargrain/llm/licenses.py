"""Operator 9: license scans by MinHash bands over overlapping text windows.

A template is a short list of word shingles. Shingles of no template are left out,
and so are templates of which a text lacks too many, which loses nothing. For
every template length the rest of the texts is cut into overlapping windows.
Windows and templates that agree on all rows of a band are candidates; the number
of bands follows from the similarity that such a window has at least and the miss
that is allowed:

    (1 - similarity ** rows) ** bands <= miss

A window is as wide as a stretch of twice the template's length and a stride more,
so that every such stretch lies in a window as a whole, and just enough of the
template among as many shingles of others as fit in is the least similarity.

A candidate is verified exactly: the share of the template's distinct shingles
that the window has. Matches of a template that overlap become one. Of templates
that match the same words (more than half of the lesser one's) the best is
reported: the one with the most shingles found less those missing, then the one
with the larger share.

Templates are held by the caller, so their size is bounded by the driver's.

Nulls and ties: null or short texts match nothing; of templates that match the
same words equally well each is reported; repeated rows are scanned one by one; null ids are kept. Templates with fewer words than a
shingle are refused. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cleargrain.llm.common import narrow, ranges, slices
from cleargrain.llm.words import ALPHANUMERIC, shingles, word_hashes

#: A short list for callers that bring none; ``license_list`` has the one of production.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
)


def bands_for(similarity: float, rows: int, miss: float) -> int:
    """Bands that miss a window of this similarity with at most this probability."""
    return math.ceil(math.log(miss) / math.log(1 - similarity**rows))


_ODD = np.uint64(0x9E3779B97F4A7C15)


class Index:
    """Band keys of the templates by window length."""

    def __init__(self, templates, *, shingle: int = 5, containment: float = 0.8, rows: int = 2, miss: float = 0.005, seed: int = 9):
        self.shingle, self.containment, self.rows, self.miss = shingle, containment, rows, miss
        self.names, self.sets = [], []
        for name, text in templates:
            words = word_hashes(pa.array([text]), ALPHANUMERIC)[0]
            if len(words) < shingle:
                raise ValueError(f"The template {name!r} has fewer words than a shingle")
            self.names.append(name)
            self.sets.append(np.unique(shingles(words, shingle)))
        self.sizes = np.array([len(x) for x in self.sets], np.int64)
        #: The fewest shingles that make a match.
        self.least = np.array([next(n for n in range(int(containment * k), k + 1) if n / k >= containment) for k in self.sizes.tolist()], np.int64)
        self.lengths = np.unique(self.sizes).tolist()
        self.bands = {length: self.bands_of(length) for length in self.lengths}
        many = max(self.bands.values(), default=0) * rows
        self.factors = np.random.default_rng(seed).integers(1 << 30, 1 << 32, many, dtype=np.uint32) | np.uint32(1)
        every = np.concatenate(self.sets) if self.sets else np.empty(0, np.uint64)
        self.vocabulary, at = np.unique(every, return_inverse=True)
        self.owners = np.repeat(np.arange(len(self.sets)), self.sizes)[np.argsort(at, kind="stable")]
        self.owned = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(self.vocabulary)))]).astype(np.int64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.vocabulary >> np.uint64(44)] = True
        #: By length: the templates, and their keys a band.
        self.keys: dict[int, tuple[np.ndarray, list[np.ndarray]]] = {}
        for length in self.lengths:
            numbers = np.flatnonzero(self.sizes == length)
            first = np.arange(len(numbers)) * length
            self.keys[length] = (numbers, list(self.band_keys(np.concatenate([self.sets[n] for n in numbers]), first, first + length, self.bands[length])))

    def stride(self, length: int) -> int:
        return max(1, length // 4)

    def width(self, length: int) -> int:
        """Shingles of a window: those of any stretch of twice the template's length and two, wherever it begins."""
        return length + 2 * (length // 2 + 1) + self.stride(length)

    def bands_of(self, length: int) -> int:
        """Bands that find the least similar window that verify accepts: just enough of the template, the rest from others."""
        enough = next(n for n in range(int(self.containment * length), length + 1) if n / length >= self.containment)
        return bands_for(enough / (length + self.width(length) - enough), self.rows, self.miss)

    def band_keys(self, grams: np.ndarray, first: np.ndarray, end: np.ndarray, bands: int) -> Iterator[np.ndarray]:
        """For each band, the keys of the windows from ``first`` to ``end``, none of them empty."""
        short = (grams >> np.uint64(32)).astype(np.uint32)
        edges = np.stack([first, end], 1).ravel()
        held = np.zeros(len(first), np.uint64)
        for i, factor in enumerate(self.factors[: bands * self.rows]):
            hashes = np.append(short * factor, np.uint32(0xFFFFFFFF))
            held = held * _ODD + np.minimum.reduceat(hashes, edges)[::2]
            if i % self.rows == self.rows - 1:
                yield held
                held = np.zeros(len(first), np.uint64)

    def windows(self, length: int, places: np.ndarray, bases: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and end hit, and text, of the windows with enough hits for a template of this length.

        ``places``: the hits' places among all shingles; ``bases`` and ``texts``: the first place and number of their texts.
        """
        width, stride = self.width(length), self.stride(length)
        inside = places - bases
        low = np.maximum(0, (inside - width) // stride + 1)
        each = inside // stride - low + 1
        begin = np.repeat(bases, each) + ranges(low, each) * stride
        text = np.repeat(texts, each)
        order = np.lexsort((begin, text))
        begin, text = begin[order], text[order]
        new = np.concatenate([[True], (begin[1:] != begin[:-1]) | (text[1:] != text[:-1])])
        begin, text = begin[new], text[new]
        first, end = np.searchsorted(places, begin), np.searchsorted(places, begin + width)
        # A window ends where its text does.
        end = np.minimum(end, np.searchsorted(texts, text, side="right"))
        enough = end - first >= self.least[self.sizes == length][0]
        return first[enough], end[enough], text[enough]

    def candidates(self, grams: np.ndarray, places: np.ndarray, bases: np.ndarray, texts: np.ndarray, known: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(first hit, end hit, template), for each template its windows in order."""
        text, shingle = np.divmod(np.unique(texts * len(self.vocabulary) + known), len(self.vocabulary))
        many = self.owned[shingle + 1] - self.owned[shingle]
        own = self.owners[ranges(self.owned[shingle], many)]
        both, seen = np.unique(np.repeat(text, many) * len(self.sets) + own, return_counts=True)
        number = both % len(self.sets)
        enough = seen >= self.least[number]
        both, number = both[enough], number[enough]
        for length in np.unique(self.sizes[number]).tolist():
            here = self.sizes[number] == length
            kept = np.flatnonzero(np.isin(texts, both[here] // len(self.sets)))
            first, end, text = self.windows(length, places[kept], bases[kept], texts[kept])
            if not len(first):
                continue
            numbers, keys = self.keys[length]
            wanted = np.flatnonzero(np.isin(numbers, number[here]))
            each = []
            for own_keys, window_keys in zip(keys, self.band_keys(grams[kept], first, end, self.bands[length]), strict=True):
                order = np.argsort(own_keys[wanted], kind="stable")
                ordered = own_keys[wanted][order]
                low, high = (np.searchsorted(ordered, window_keys, side=x) for x in ("left", "right"))
                hit = np.repeat(np.arange(len(first)), high - low)
                each.append(order[ranges(low, high - low)] * len(first) + hit)
            found = np.unique(np.concatenate(each))
            window = found % len(first)
            chosen = numbers[wanted][found // len(first)]
            real = np.isin(text[window] * len(self.sets) + chosen, both[here])
            for w, n in zip(window[real].tolist(), chosen[real].tolist(), strict=True):
                yield int(kept[first[w]]), int(kept[end[w] - 1]) + 1, n

    def verify(self, grams: np.ndarray, first: int, end: int, number: int) -> tuple[int, np.ndarray] | None:
        """How many shingles of the template the window holds, and the hits that are its, if these are enough."""
        inside = np.flatnonzero(np.isin(grams[first:end], self.sets[number]))
        count = len(np.unique(grams[first + inside]))
        return (count, first + inside) if count >= self.least[number] else None

    def scan(self, texts: pa.Array) -> list[list[tuple[str, float, int, int]]]:
        """For each text: template name, containment, first and end byte of each match."""
        words, begins, ends, before = word_hashes(texts, ALPHANUMERIC)
        counts = np.maximum(np.diff(before) - self.shingle + 1, 0)
        own = [shingles(words[a:b], self.shingle) for a, b in zip(before[:-1], before[1:], strict=True)]
        grams = np.concatenate(own) if own else np.empty(0, np.uint64)
        out: list[list[tuple[str, float, int, int]]] = [[] for _ in range(len(texts))]
        places = np.flatnonzero(self.maybe[grams >> np.uint64(44)])
        if not len(places) or not len(self.vocabulary):
            return out
        known = np.minimum(np.searchsorted(self.vocabulary, grams[places]), len(self.vocabulary) - 1)
        real = self.vocabulary[known] == grams[places]
        places, known = places[real], known[real]
        starts = np.cumsum(counts) - counts
        text_of = np.repeat(np.arange(len(counts)), counts)[places]
        word_of = places - starts[text_of] + before[text_of]
        grams = grams[places]
        matches: list[tuple[int, int, list[np.ndarray]]] = []  # template, shingles found, hits
        for first, end, number in self.candidates(grams, places, starts[text_of], text_of, known):
            if match := self.verify(grams, first, end, number):
                count, hits = match
                if matches and matches[-1][0] == number:
                    _, most, held = matches[-1]
                    if text_of[held[-1][-1]] == text_of[hits[0]] and word_of[hits[0]] < word_of[held[-1][-1]] + self.shingle:
                        matches[-1] = (number, max(most, count), [*held, hits])
                        continue
                matches.append((number, count, [hits]))
        text_bytes = np.concatenate([[0], np.cumsum([len(x.as_buffer()) for x in texts.cast(pa.binary())])])
        for number, count, first_word, last_word, text in self.best(matches, word_of, text_of, len(words)):
            span = (int(begins[first_word] - text_bytes[text]), int(ends[last_word] - text_bytes[text]))
            out[text].append((self.names[number], count / int(self.sizes[number]), *span))
        return [self.joined(found) for found in out]

    def best(self, matches, word_of: np.ndarray, text_of: np.ndarray, total: int) -> Iterator[tuple[int, int, int, int, int]]:
        """Template, shingles found, first and last word, and text of the matches that no better one covers by more than half."""
        ranked = sorted(((-(2 * count - int(self.sizes[number])), -count / int(self.sizes[number])), k) for k, (number, count, _) in enumerate(matches))
        taken, rank, last = np.full(total, len(ranked), np.int64), -1, None
        for key, k in ranked:
            if key != last:
                rank, last = rank + 1, key
            number, count, hits = matches[k]
            every = np.unique(np.concatenate(hits))
            held = np.unique((word_of[every][:, None] + np.arange(self.shingle)).ravel())
            if 2 * np.count_nonzero(taken[held] < rank) <= len(held):
                taken[held] = np.minimum(taken[held], rank)
                yield number, count, int(held[0]), int(held[-1]), int(text_of[every[0]])

    @staticmethod
    def joined(found: list[tuple[str, float, int, int]]) -> list[tuple[str, float, int, int]]:
        """Overlapping matches of one name as one."""
        out: list[tuple[str, float, int, int]] = []
        last: dict[str, int] = {}
        for name, share, first, end in sorted(found, key=lambda m: m[2:]):
            at = last.get(name)
            if at is not None and first < out[at][3]:
                out[at] = (name, max(share, out[at][1]), out[at][2], max(end, out[at][3]))
            else:
                last[name] = len(out)
                out.append((name, share, first, end))
        return out


_MATCHES = pa.list_(pa.struct([("license", pa.string()), ("containment", pa.float64()), ("first", pa.int64()), ("last", pa.int64())]))


def find_licenses(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, *, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """doc_id, matches: array of license, containment, first and last byte (exclusive)."""
    index = docs.sparkSession.sparkContext.broadcast(Index(templates, **settings))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("license", "containment", "first", "last")
        for batch in slices(batches):
            found = index.value.scan(batch.column("text").cast(pa.string()))
            rows = [[dict(zip(names, x, strict=True)) for x in sorted(own, key=lambda m: m[2:])] for own in found]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, _MATCHES)], names=["doc_id", "matches"])

    schema = "doc_id long, matches array<struct<license: string, containment: double, first: long, last: long>>"
    return narrow(docs, id_col, text_col).mapInArrow(look, schema)
