"""Whole texts to token ids, with the ids of a word looked up once it is known.

A byte-pair tokenizer splits a text into words before it merges, and no merge
crosses a word. Words repeat far more often than texts, so a worker keeps the ids
of the words it has met, up to a number of words and bytes. Cuts are made only where the tokenizer itself cuts:

* Texts of Latin letters, digits and ASCII signs are cut at the borders between
  letters, other signs and white space, for all texts of a slice at once: numpy
  finds the borders, hashes each word to 128 bits and looks the hashes up.
* Any other text, and one with an apostrophe (which joins a contraction), is cut
  at white space alone, by a pattern.
* A text that could hold a special token, or control characters on which the
  libraries disagree, goes to the tokenizer whole. So does every text when the
  tokenizer file is of a kind whose cuts are not known here.

Every word goes through the tokenizer itself, so the ids are the tokenizer's.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from cleargrain.llm.common import hold, mix, ranges, slices

#: Words, and bytes of words and ids, that a worker keeps; beyond either the words that no later slice met go.
KNOWN_WORDS = 1 << 18
KNOWN_BYTES = 16 << 20
#: Bytes of text whose words are hashed together.
BLOCK = 1 << 19
#: Words longer than this, in bytes, are rare and take the slower way.
LONG_WORD = 512

_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WHOLE = re.compile(r"<\||[\x00-\x08\x0e-\x1f\x7f-\x84\x86-\x9f\u180e\u200b\ufeff]")
_CUTS = {
    # White space belongs to the word after it, or is a word of its own.
    "kept": re.compile(rf"[{_SPACE}]+(?![^{_SPACE}])| ?[^{_SPACE}]+|[{_SPACE}]+"),
    # White space is dropped.
    "dropped": re.compile(rf"[^{_SPACE}]+"),
}
_SIGN, _LETTER, _WHITE, _OTHER = 0, 1, 2, 3


def _byte_kinds() -> np.ndarray:
    """Kinds of UTF-8 bytes; lead bytes C3 to C9 begin U+00C0 to U+027F, all letters but for three."""
    kinds = np.full(256, _OTHER, np.uint8)
    kinds[0x21:0x7F] = _SIGN
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = _LETTER
    kinds[[0x09, 0x0A, 0x0D, 0x20]] = _WHITE
    kinds[0x27] = _OTHER  # the apostrophe
    return kinds


_KINDS = _byte_kinds()
#: Two bytes that are no plain letter, or may begin a special token: times and division sign, dotted capital I, "<|".
_ODD_PAIRS = ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0), (0x3C, 0x7C))

_random = np.random.default_rng(20)
_BYTE_HASHES = _random.integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_ODD = int(_random.integers(1 << 62, 1 << 63)) | 1
_POWERS, _INVERSES = (
    np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(BLOCK + LONG_WORD, x, np.uint64)])) for x in (_ODD, pow(_ODD, -1, 1 << 64))
)


def _white_space(tokenizer) -> str | None:
    """What the tokenizer does with white space; None: unknown, so texts stay whole."""
    before, normal = (json.loads(x.__getstate__()) if x else {} for x in (tokenizer.pre_tokenizer, tokenizer.normalizer))
    if type(tokenizer.model).__name__ != "BPE" or tokenizer.model.dropout:
        return None
    if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not normal:
        return "kept"
    split, harmless = before.get("pretokenizers", [{}])[0], {"NFC", "Replace", "Lowercase"}
    if split.get("type") == "Split" and split.get("invert") and split.get("behavior") == "Removed":
        pattern = split["pattern"].get("Regex", "")
        if pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+") and {x["type"] for x in normal.get("normalizers", [])} <= harmless:
            return "dropped"
    return None


class _Table:
    """Numbers of 128-bit keys, in an open-addressed table of numpy arrays.

    The first half of a key chooses the slot, the second half is compared."""

    def __init__(self, bits: int = 16):
        self._shift, self._last, self._filled = np.uint64(64 - bits), (1 << bits) - 1, 0
        self._keys, self._numbers = np.zeros((2, 1 << bits), np.uint64), np.full(1 << bits, -1, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        slots = (keys[0] >> self._shift).astype(np.int64)
        out = self._numbers[slots]
        wait = np.flatnonzero((out >= 0) & (self._keys[1][slots] != keys[1]))
        slots = slots[wait]
        while len(wait):
            slots = (slots + 1) & self._last
            out[wait] = found = self._numbers[slots]
            again = (found >= 0) & (self._keys[1][slots] != keys[1][wait])
            wait, slots = wait[again], slots[again]
        return out

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """All keys and their numbers."""
        full = self._numbers >= 0
        return self._keys[:, full], self._numbers[full]

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Put distinct new keys in; the table stays under half full."""
        self._filled += len(numbers)
        if 2 * self._filled > self._last:
            old, held = self._numbers >= 0, self._filled - len(numbers)
            old_keys, old_numbers = self._keys[:, old], self._numbers[old]
            self.__init__((4 * self._filled).bit_length())
            self.add(old_keys, old_numbers)
            self._filled = held + len(numbers)
        slots = (keys[0] >> self._shift).astype(np.int64)
        wait = np.arange(len(numbers))
        while len(wait):
            open_slots = np.flatnonzero(self._numbers[slots] < 0)
            free, first = np.unique(slots[open_slots], return_index=True)
            put = open_slots[first]
            self._keys[:, free], self._numbers[free] = keys[:, wait[put]], numbers[wait[put]]
            stay = np.ones(len(wait), bool)
            stay[put] = False
            wait, slots = wait[stay], (slots[stay] + 1) & self._last


class Encoder:
    """Ids of whole texts by one tokenizer file."""

    def __init__(self, path: str, known_words: int = KNOWN_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._white = _white_space(self._tokenizer)
        self._ends = np.zeros(self._tokenizer.get_vocab_size(), bool)  # ids that end a word in _learn_letters
        if self._white == "kept":
            self._ends[self._tokenizer.encode("\n", add_special_tokens=False).ids] = True
        elif self._white == "dropped":
            self._ends[[i for x, i in self._tokenizer.get_vocab().items() if x.endswith("</w>")]] = True
        self._limit = known_words
        self.forget()

    def forget(self) -> None:
        """Drop the known words."""
        self._table = _Table()
        self._by_word: dict[str, int] = {}
        self._flat = np.empty(1 << 16, np.int32)
        self._starts, self._lengths = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self._met = np.zeros(1 << 14, bool)  # by a slice after the one that learned the word, since the last bound
        self._words = self._used = self._held = 0

    def bound(self) -> None:
        """Beyond the bounds keep the words met again, or none if they fill more than half of either."""
        if self._words <= self._limit and self._held + 4 * self._used <= KNOWN_BYTES:
            return
        stay = np.flatnonzero(self._met[: self._words])
        lengths, by_word = self._lengths[stay], {w: n for w, n in self._by_word.items() if self._met[n]}
        held = sum(map(len, by_word))
        if 2 * len(stay) > self._limit or 2 * (held + 4 * int(lengths.sum())) > KNOWN_BYTES:
            return self.forget()
        flat, table = self._flat[ranges(self._starts[stay], lengths)], self._table
        anew = np.full(self._words, -1, np.int64)
        anew[stay] = np.arange(len(stay))
        self.forget()
        self._keep(flat, lengths)
        keys, numbers = table.entries()
        there = anew[numbers] >= 0
        self._table.add(keys[:, there], anew[numbers[there]])
        self._by_word, self._held = {w: int(anew[n]) for w, n in by_word.items()}, held

    def _learn(self, words: list[str]) -> np.ndarray:
        """Numbers of new words, whose ids are kept from now on."""
        ids = [x.ids for x in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return self._keep(np.fromiter(chain.from_iterable(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids)))

    def _learn_letters(self, block: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
        """The same for words of letters alone, joined for one call: the tokenizer marks where each ends."""
        after = np.cumsum(to - at + 1)
        joined, letter = np.full(int(after[-1]), 0x0A, np.uint8), np.ones(int(after[-1]), bool)
        letter[after - 1] = False
        joined[letter] = block[ranges(at, to - at)]
        text = joined.tobytes().decode()
        ids = np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
        ends = np.flatnonzero(self._ends[ids])
        if len(ends) != len(at):
            return self._learn(text.split("\n")[:-1])
        lengths = np.diff(ends, prepend=-1)
        if self._white == "kept":  # the mark is the line break, which is none of the word's ids
            ids, lengths = np.delete(ids, ends), lengths - 1
        return self._keep(ids, lengths)

    def _keep(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        total, end = len(ids), self._words + len(lengths)
        while self._used + total > len(self._flat):
            self._flat = np.concatenate([self._flat, np.empty_like(self._flat)])
        while end > len(self._starts):
            self._starts = np.concatenate([self._starts, np.zeros_like(self._starts)])
            self._lengths = np.concatenate([self._lengths, np.zeros_like(self._lengths)])
            self._met = np.concatenate([self._met, np.zeros_like(self._met)])
        self._flat[self._used : self._used + total] = ids
        self._lengths[self._words : end] = lengths
        self._starts[self._words : end] = self._used + np.cumsum(lengths) - lengths
        numbers = np.arange(self._words, end)
        self._used, self._words = self._used + total, end
        return numbers

    def _numbers_of(self, words: list[str]) -> np.ndarray:
        known = self._by_word
        if new := [w for w in dict.fromkeys(words) if w not in known]:
            known.update(zip(new, self._learn(new).tolist(), strict=True))
            self._held += sum(map(len, new))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def _borders(self, data: np.ndarray, starts: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place (exclusive) of each word of plain texts that begin at ``starts``."""
        edge = np.zeros(len(data) + 1, bool)
        edge[starts] = True
        edge[-1] = True
        white = kinds == _WHITE
        change = np.concatenate([[True], kinds[1:] != kinds[:-1]]) | edge[:-1]
        if self._white == "dropped":
            begins = np.flatnonzero(change & ~white)
            ends = np.flatnonzero(np.concatenate([change[1:], [True]]) & ~white) + 1
            return begins, ends
        before = np.concatenate([[False], white[:-1]]) & ~edge[:-1]  # white space precedes in the same text
        space = np.concatenate([[False], data[:-1] == 0x20]) & before
        follows = np.concatenate([~white[1:], [False]]) & ~edge[1:]  # a word follows in the same text
        begin = np.where(white, ~before | follows, change & ~space)
        begins = np.flatnonzero(begin | edge[:-1])
        return begins, np.concatenate([begins[1:], [len(data)]])

    def _plain_words(self, data: np.ndarray, kinds: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Numbers of words, block by block."""
        out, first = np.empty(len(begins), np.int64), 0
        while first < len(begins):
            last = max(first + 1, int(np.searchsorted(ends, begins[first] + BLOCK, side="right")))
            b, e = begins[first:last], ends[first:last]
            long = e - b > LONG_WORD
            base = int(b[0])
            if len(b) == 1 and long[0]:
                out[first] = self._numbers_of([data[b[0] : e[0]].tobytes().decode()])[0]
                first = last
                continue
            block, at, to = data[base : int(e[-1])], b - base, e - base
            keys = np.empty((2, len(b)), np.uint64)
            for i in range(2):
                sums = np.zeros(len(block) + 1, np.uint64)
                np.cumsum(_BYTE_HASHES[i][block] * _POWERS[: len(block)], out=sums[1:])
                keys[i] = mix((sums[to] - sums[at]) * _INVERSES[at])
            numbers = self._table.find(keys).astype(np.int64)
            if len(new := np.flatnonzero((numbers < 0) & ~long)):
                _, one, which = np.unique(keys[0][new], return_index=True, return_inverse=True)
                one = new[one]
                letters = kinds[b[one] + (data[b[one]] == 0x20) * (e[one] - b[one] > 1)] == _LETTER
                added = np.empty(len(one), np.int64)
                if len(rows := np.flatnonzero(letters)):
                    added[rows] = self._learn_letters(block, at[one[rows]], to[one[rows]])
                if len(rows := np.flatnonzero(~letters)):
                    added[rows] = self._learn([block[at[i] : to[i]].tobytes().decode() for i in one[rows].tolist()])
                self._table.add(keys[:, one], added)
                numbers[new] = added[which]
            if long.any():
                rows = np.flatnonzero(long)
                numbers[rows] = self._numbers_of([block[at[i] : to[i]].tobytes().decode() for i in rows])
            out[first:last], first = numbers, last
        return out

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and how many each text has."""
        self.bound()
        known = self._words
        offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.empty(0, np.uint8)
        offsets -= offsets[0]
        kinds = _KINDS[data]
        odd = kinds == _OTHER
        for a, b in _ODD_PAIRS:
            odd[:-1] |= (data[:-1] == a) & (data[1:] == b)
        sums = np.concatenate([[0], np.cumsum(odd)])
        plain = (sums[offsets[1:]] == sums[offsets[:-1]]) & (self._white is not None)
        counts, odd_numbers = np.zeros(len(texts), np.int64), {}
        for i in np.flatnonzero(~plain).tolist():
            text = texts[i].as_py()
            whole = self._white is None or _WHOLE.search(text)
            odd_numbers[i] = self._numbers_of([text] if whole else _CUTS[self._white].findall(text))
            counts[i] = len(odd_numbers[i])
        if plain.all():
            joined, starts, kind = data, offsets[:-1], kinds
        else:
            keep = np.repeat(plain, np.diff(offsets))
            joined, kind, sizes = data[keep], kinds[keep], np.diff(offsets)[plain]
            starts = np.cumsum(sizes) - sizes
        if len(joined):
            begins, ends = self._borders(joined, starts[starts < len(joined)], kind)
            numbers = self._plain_words(joined, kind, begins, ends)
            places = np.searchsorted(begins, np.append(starts, len(joined)))
            counts[plain] = np.diff(places)
        else:
            numbers = np.empty(0, np.int64)
        if odd_numbers:
            ends = np.cumsum(counts)
            every = np.empty(int(ends[-1]), np.int64)
            every[np.repeat(plain, counts)] = numbers
            for i, own in odd_numbers.items():
                every[ends[i] - counts[i] : ends[i]] = own
            numbers = every
        self._met[numbers[numbers < known]] = True
        lengths = self._lengths[numbers]
        before = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(counts)
        return self._flat[ranges(self._starts[numbers], lengths)], before[ends] - before[ends - counts]


def encoder(path: str) -> Encoder:
    """The worker's own for this file; Spark keeps workers between tasks."""
    return hold(("encoder", path), lambda: Encoder(path))


def encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the rows with their ids, ``end_id`` after each text, and the first place of each text."""
    for batch in slices(batches, using=("encoder", path)):
        ids, counts = encoder(path).encode(batch.column("text").cast(pa.string()))
        ends = np.cumsum(counts + 1)
        with_end = np.full(len(ids) + len(counts), end_id, np.int32)
        keep = np.ones(len(with_end), bool)
        keep[ends - 1] = False
        with_end[keep] = ids
        yield batch, with_end, np.concatenate([[0], ends])
    encoder(path).bound()
