"""Words and shingles of whole texts as 64-bit hashes, computed in place in Arrow's buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from cleargrain.llm.common import ASCII_LOWER, mix

_random = np.random.default_rng(11)
_BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_ODD = np.uint64(int(_random.integers(1 << 62, 1 << 63)) | 1)
_PLACES = [np.uint64(int(x) | 1) for x in _random.integers(1 << 62, 1 << 63, 16)]
_LOWER = np.frombuffer(ASCII_LOWER, np.uint8)

#: Bytes of words that end at ASCII white space.
NOT_SPACE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
#: Bytes of words of digits, ASCII letters and all beyond ASCII.
ALPHANUMERIC = np.array([0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and each text's first place with the end of the last."""
    texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def word_hashes(texts: pa.Array, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of each word, A-Z lower-cased, and the words before each text (with the total).

    Places count from the first text's first byte.
    """
    data, offsets = buffers(texts)
    if not len(data):
        empty = np.empty(0, np.int64)
        return empty.astype(np.uint64), empty, empty, np.zeros(len(offsets), np.int64)
    inside = word_bytes[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    if not len(begins):
        return begins.astype(np.uint64), begins, ends, np.zeros(len(offsets), np.int64)
    lengths = ends - begins
    powers = np.full(int(lengths.max()), _ODD, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    at = np.flatnonzero(inside)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(at)) - np.repeat(starts, lengths)
    hashes = mix(np.add.reduceat(_BYTES[_LOWER[data[at]]] * powers[place], starts) + lengths.astype(np.uint64))
    return hashes, begins, ends, np.searchsorted(begins, offsets)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every ``size`` successive words."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for i in range(size):
        out += words[i : i + count] * _PLACES[i]
    return mix(out)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles in order; fewer words than a shingle are one as a whole."""
    if not len(words):
        return np.empty(0, np.uint64)
    if len(words) < size:
        return shingles(words, len(words)) ^ np.uint64(len(words))
    return np.unique(shingles(words, size))
