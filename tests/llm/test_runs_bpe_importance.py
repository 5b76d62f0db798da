"""Operators 11 to 13 against plain Python, the tokenizer library and hand-made cases."""

import base64
import hashlib
import math
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from brute import LOWER

from cleargrain.llm import byte_bpe, importance, runs
from cleargrain.llm.queries import MULTI_BPE, planted_periods
from cleargrain.llm.words import buffers

RANKS = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, open(MULTI_BPE, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def brute_runs(words, least=12):
    """(start, period, length) of every run: all periods, the smallest kept for a stretch."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, 2 * p):
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted((s, p, n) for (s, n), p in found.items())


def brute_collapsed(words, found):
    gone = {i for s, p, n in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def fibonacci(length):
    a, b = ["x"], ["x", "y"]
    while len(b) < length:
        a, b = b, b + a
    return b[:length]


@pytest.fixture(scope="module")
def periodic_rows(hard_rows):
    rng = random.Random(7)
    rows = list(hard_rows) + [(600, " ".join(fibonacci(400))), (601, "a " * 900), (602, "a b\n" * 333 + "a"), (603, "a\u0085a " * 40)]
    for n in range(60):
        words = [rng.choice("abcdefgh"[: rng.randint(1, 8)]) for _ in range(rng.randint(10, 150))]
        a, p = rng.randrange(len(words)), rng.randint(1, 20)
        rows.append((700 + n, " ".join(words[:a] + [words[a + i % min(p, len(words) - a)] for i in range(rng.randint(0, 90))] + words[a:])))
    return rows


@pytest.mark.parametrize("grid", [64, 1 << 20])
def test_runs_against_all_periods(monkeypatch, grid):
    """Small alphabets, Fibonacci words and blocks; the grid in small parts too."""
    monkeypatch.setattr(runs, "GRID", grid)
    rng = random.Random(grid)
    for _ in range(120):
        texts = []
        for _ in range(rng.randint(0, 9)):
            length = rng.choice([0, 1, 11, 12, 30, 120])
            texts.append(rng.choice([[rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(length)], [ord(x) for x in fibonacci(length)]]))
        counts = np.array([len(x) for x in texts], np.int64)
        symbols = np.array([x for text in texts for x in text], np.int64)
        got = [[] for _ in texts]
        for text, start, length, period in zip(*(x.tolist() for x in runs.find_runs(symbols, counts)), strict=True):
            got[text].append((start, period, length))
        assert got == [brute_runs(x) for x in texts]


def test_grammar_extends_exactly():
    rng = np.random.default_rng(3)
    symbols = np.concatenate([np.tile(rng.integers(0, 3, 50), 6), np.zeros(300, np.int64), rng.integers(0, 2, 500)])
    grammar = runs.Grammar(symbols)
    left, right = rng.integers(0, len(symbols), (2, 2000))
    left, right = left[left != right], right[left != right]

    def plain(a, b, way):
        n = 0
        while 0 <= a < len(symbols) and 0 <= b < len(symbols) and symbols[a] == symbols[b]:
            a, b, n = a + way, b + way, n + 1
        return n

    for back, way in ((False, 1), (True, -1)):
        assert grammar.agree(left, right, back=back).tolist() == [plain(a, b, way) for a, b in zip(left.tolist(), right.tolist(), strict=True)]
    with pytest.raises(ValueError, match="Runs of fewer"):
        runs.find_runs(symbols, np.array([len(symbols)]), 11)


def test_periodic_runs(make_docs, periodic_rows):
    wanted = []
    for doc, text in periodic_rows:
        found = brute_runs(split(text)) if len(split(text)) < 5000 else []  # the long text holds random words
        wanted.append((doc, len(split(text)), found, brute_collapsed(split(text), found)))
    got = [
        (r.doc_id, r.n_words, [(x.start, x.period, x.length) for x in r.runs], r.collapsed) for r in runs.periodic_runs(make_docs(periodic_rows)).collect()
    ]
    assert sorted(got, key=repr) == sorted(wanted, key=repr) and sum(len(x[2]) for x in got) > 50
    assert runs.periodic_runs(make_docs([])).count() == 0


def test_one_very_long_text(make_docs):
    """Over several megabytes, with a long period near its end."""
    rng = random.Random(1)
    words = [str(rng.randrange(10**9)) for _ in range(250_000)]
    text = " ".join(words + words[-40_000:] + ["end"])
    (row,) = runs.periodic_runs(make_docs([(1, text)])).collect()
    assert [(x.start, x.length, x.period) for x in row.runs] == [(210_000, 80_000, 40_000)] and row.collapsed == " ".join([*words, "end"])


def test_planted_periods(make_docs, hard_rows):
    docs = {}
    for r in planted_periods(make_docs(hard_rows)).collect():
        docs.setdefault(r.doc_id, []).append(r.text)
    planted = 0
    for doc, text in hard_rows:
        words, h = split(text), zlib.crc32(str(doc).encode())
        if doc is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text, planted = " ".join(words[:a] + [words[a + i % p] for i in range(n - a)]), planted + 1
        assert text in docs[doc]
    assert planted > 5


PARTS = ["a", "R", "'", "s", "t", "re", "ll", "ve", "d", "m", "'s", "'LL", " ", "  ", "\n", "\t\t", "\r", "1", "٣", "Ⅷ", "é", "é", "ß", "中", "!", "?-",
         "\xa0", "　", "\x85", " ", "😀", "\U000113d1", "\x00", "<|endoftext|>", ""]


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(9)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(4000)] + ["", " ", "'", "''s's", "x'", "'r", "the " * 300, " " * 700]


@pytest.mark.parametrize("row", [3, 512])
def test_boundaries_are_the_pattern_s(monkeypatch, odd_texts, row):
    monkeypatch.setattr(byte_bpe, "ROW", row)
    pattern, wanted, base = regex.compile(public_tokenizers.PATTERN), [], 0
    for text in odd_texts:
        for match in pattern.finditer(text):
            wanted.append(base)
            base += len(match[0].encode())
    assert byte_bpe.boundaries(*buffers(pa.array(odd_texts))).tolist() == wanted


def test_classes_are_the_library_s():
    """A byte of a code point merges with a letter, number or sign before it only within one match."""
    ranks = {bytes([i]): i for i in range(256)}
    for sign in b"a1!":
        for lead in range(0xC2, 0xF5):
            ranks[bytes([sign, lead])] = len(ranks)
    library = tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    classes = byte_bpe.code_point_classes()
    unsure = [i for i in range(0x80, 0x110000) if unicodedata.category(chr(i)) == "Cn" and (classes[i] != byte_bpe.OTHER or i % 97 == 0)]
    for point in [*range(0x80, 0x3100), *unsure]:
        kinds = [kind for sign, kind in zip("a1!", (byte_bpe.LETTER, byte_bpe.NUMBER, byte_bpe.OTHER), strict=True) if library.encode_ordinary(sign + chr(point))[0] > 255]
        assert kinds == ([] if classes[point] == byte_bpe.WHITE else [classes[point]]), hex(point)


def test_ids_are_the_library_s(make_docs, odd_texts, hard_rows):
    rows = [*enumerate(odd_texts, 1000), *hard_rows, (900, "ab" * 50_000), (901, "é" * 700), (902, "!" * 5000)]
    tokens = byte_bpe.encode_documents(make_docs(rows), MULTI_BPE)
    decoded = byte_bpe.decode_documents(tokens, MULTI_BPE)
    wanted = sorted(((doc, LIBRARY.encode_ordinary(text or ""), (text or "").encode()) for doc, text in rows), key=repr)
    assert sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in decoded.collect()), key=repr) == wanted
    for r in tokens.limit(200).collect():
        sizes = [len(LIBRARY.decode_single_token_bytes(i)) for i in r.ids]
        assert list(r.starts) == np.cumsum([0, *sizes]).tolist()
    assert byte_bpe.decode_documents(byte_bpe.encode_documents(make_docs([]), MULTI_BPE), MULTI_BPE).count() == 0


@pytest.mark.parametrize("first, last", [(0, 5), (10, 40), (3, 4), (50, 10**6), (7, 7)])
def test_a_byte_range_by_itself(make_docs, hard_rows, first, last):
    rows = [(d, t) for d, t in hard_rows if d is not None and d != 11]
    texts = {d: (t or "").encode() for d, t in rows}
    part = byte_bpe.byte_range(byte_bpe.encode_documents(make_docs(rows), MULTI_BPE), first, last)
    for r in byte_bpe.decode_documents(part, MULTI_BPE).collect():
        wanted = texts[r.doc_id][first:last]
        assert wanted in bytes(r.decoded) and bytes(r.decoded) in texts[r.doc_id]


def test_known_slices_are_bounded(monkeypatch, odd_texts):
    monkeypatch.setattr(byte_bpe, "KNOWN_SLICES", 50)
    monkeypatch.setattr(byte_bpe, "LONG_SLICE", 4)
    bpe = byte_bpe.ByteBPE(MULTI_BPE)
    for i in range(0, 2000, 40):
        ids, counts = bpe.encode(pa.array(odd_texts[i : i + 40]))
        wanted = [LIBRARY.encode_ordinary(x) for x in odd_texts[i : i + 40]]
        assert counts.tolist() == list(map(len, wanted)) and ids.tolist() == [x for row in wanted for x in row]


def grams_of(text, grams=3):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


@pytest.mark.parametrize("length", [0, 1, 63, 64, 65, 1000, 70_000])
def test_a_crc_of_two_parts(length):
    a, b = b"some words", random.Random(length).randbytes(length)
    assert importance.shifted(np.array([zlib.crc32(a)], np.uint32), np.array([length]))[0] ^ zlib.crc32(b) == zlib.crc32(a + b)


@pytest.mark.parametrize("grams, piece", [(1, 1 << 20), (3, 1 << 20), (3, 50), (5, 50)])
def test_features(make_docs, hard_rows, monkeypatch, grams, piece):
    monkeypatch.setattr(importance, "PIECE", piece)
    texts = [t or "" for _, t in hard_rows if t is None or len(t) < 5000 or piece > 50]
    words, counts, found = importance.feature_buckets(pa.array(texts), grams, 1000)
    ends = np.cumsum(counts)
    got = [(n, Counter(found[e - c : e].tolist())) for n, c, e in zip(words.tolist(), counts.tolist(), ends.tolist(), strict=True)]
    assert got == [(n, Counter(bucket(f, 1000) for f in own)) for n, own in (grams_of(t, grams) for t in texts)]


def brute_resample(rows, items, percent, buckets, seed):
    source, target = Counter(), Counter()
    for held, table in ((source, rows), (target, items)):
        for _, text in table:
            held.update(bucket(f, buckets) for f in grams_of(text)[1])
    all_s, all_t = source.total() + buckets, target.total() + buckets
    gain = [math.floor(1000 * math.log((target[b] + 1) * all_s / ((source[b] + 1) * all_t))) for b in range(buckets)]
    out = []
    for doc, text in rows:
        n, own = grams_of(text)
        weight = sum(gain[bucket(f, buckets)] for f in own)
        h = int(hashlib.sha256(f"{seed}:{'null' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, n, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((x for x in out if x[1] >= 20), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    drawn = order[: percent * len(order) // 100]
    ranks = {id(x): i for i, x in enumerate(drawn, 1)}
    return [(x[0], *x[2:], ranks.get(id(x))) for x in out]


@pytest.mark.parametrize("percent", [5, 50, 100, 0])
def test_resample(spark, make_docs, hard_rows, percent):
    items = [(1, "the two words of a target"), (2, None), (3, hard_rows[7][1]), (3, hard_rows[7][1])]
    target = spark.createDataFrame(items, "item_id long, text string")
    got = importance.resample(make_docs(hard_rows), target, percent=percent, buckets=500, seed=7)
    wanted = brute_resample(hard_rows, items, percent, 500, 7)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(wanted, key=repr)


def test_resample_of_nothing(make_docs):
    assert importance.resample(make_docs([]), make_docs([]), target_id_col="doc_id").count() == 0
    alone = importance.resample(make_docs([(1, None), (2, "a b")]), make_docs([]), target_id_col="doc_id", percent=100, min_words=1)
    assert sorted((r.doc_id, r.n_features, r.rank) for r in alone.collect()) == [(1, 0, None), (2, 3, 1)]
