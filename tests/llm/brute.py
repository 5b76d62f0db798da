"""The operators' answers, worked out row by row in plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_sets(rows, size):
    out = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        out.append(set() if not words else {tuple(words)} if len(words) < size else set(zip(*(words[i:] for i in range(size)), strict=False)))
    return out


def components(rows, size, percent):
    """(set size, smallest id of the component) of each row."""
    sets, above = shingle_sets(rows, size), list(range(len(rows)))

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                above[top(i)] = top(j)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        ids[top(i)].append(doc)
    best = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return [(len(s), best[top(i)] if s else rows[i][0]) for i, s in enumerate(sets)]


def repeats(rows, threshold):
    """(bytes, removed bytes, removed runs, sha256 of the rest) of each row."""
    texts = [(text or "").encode() for _, text in rows]
    seen = Counter(t[p : p + threshold] for t in texts for p in range(len(t) - threshold + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - threshold + 1):
            if seen[t[p : p + threshold]] > 1:
                gone[p : p + threshold] = b"\1" * threshold
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = len([x for x in bytes(gone).split(b"\0") if x])
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def contamination(rows, items, window):
    """(words, hit words, items) of each row."""
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    grams = defaultdict(set)
    for item, text in items:
        own = words(text)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            grams[tuple(own[i : i + size])].add(item)
    out = []
    for _, text in rows:
        own, hit, names = words(text), set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(own) - size + 1):
                if found := grams.get(tuple(own[i : i + size])):
                    hit.update(range(i, i + size))
                    names |= found
        out.append((len(own), len(hit), names))
    return out
