import random
import re

import numpy as np
import pytest
from brute import LOWER, components, contamination, repeats

from cleargrain.llm import bloom, decontaminate, exact_dedup, jaccard, licenses
from cleargrain.llm import components as graph
from cleargrain.llm import repeats as suffixes
from cleargrain.llm.jaccard import Bands, signatures


def as_rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def test_bloom_lets_every_repeated_hash_through(spark):
    hashes = spark.range(5000).selectExpr("xxhash64(id % 4000) AS h")
    words = bloom.repeated(hashes).value
    all_hashes = np.array([r.h for r in spark.range(4000).selectExpr("xxhash64(id) AS h").collect()])
    through = bloom.held(words, all_hashes)
    assert through[:1000].all() and through[1000:].mean() < 0.1
    assert bloom.held(bloom.holding(hashes).value, all_hashes).all()


def test_exact_groups(make_docs, hard_rows):
    groups = {}
    for doc, text in hard_rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc)
    wanted = []
    for doc, text in hard_rows:
        own = groups[(text or "").translate(LOWER)]
        keep = max((x for x in own if x is not None), default=None)
        wanted.append((doc, keep, len(own), doc == keep))
    assert as_rows(exact_dedup.group_copies(make_docs(hard_rows)), "id", "keep_id", "group_size", "kept") == sorted(wanted, key=repr)


def test_exact_drop_keeps_columns(make_docs, hard_rows):
    docs = make_docs(hard_rows)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert len({(t or "").translate(LOWER) for _, t in hard_rows}) == kept.count()
    assert exact_dedup.drop_duplicates(docs.limit(0)).count() == 0
    assert exact_dedup.group_copies(docs.limit(0)).count() == 0


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80)])
def test_jaccard_components(make_docs, hard_rows, size, percent):
    wanted = sorted(((d, *c) for (d, _), c in zip(hard_rows, components(hard_rows, size, percent), strict=True)), key=repr)
    found = jaccard.jaccard_components(make_docs(hard_rows), shingle=size, percent=percent)
    assert as_rows(found, "doc_id", "n_shingles", "component_id") == wanted


def test_jaccard_on_nothing(make_docs):
    assert jaccard.jaccard_components(make_docs([])).count() == 0
    lone = make_docs([(1, None), (2, "a b c d e f"), (3, "g h i j k l")])
    assert as_rows(jaccard.jaccard_components(lone), "doc_id", "component_id") == [(1, 1), (2, 2), (3, 3)]


def test_one_near_copy_stays(make_docs, hard_rows):
    docs = make_docs(hard_rows)
    kept = jaccard.drop_near_duplicates(docs)
    wanted = {d for (d, _), (_, c) in zip(hard_rows, components(hard_rows, 5, 80), strict=True) if d == c}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == wanted


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_share_a_signature(percent):
    """Pairs just over the threshold, of all sizes."""
    rng, missed = np.random.default_rng(percent), 0
    for turn in range(600):
        common = int(rng.integers(1, 400)) if turn % 2 else int(rng.integers(1, 30))
        extra = int(common * (100 - percent) / percent)
        left = int(rng.integers(0, extra + 1))
        every = rng.integers(0, 1 << 63, common + extra, dtype=np.uint64) * np.uint64(2)
        a = np.unique(every[: common + left])
        b = np.unique(np.concatenate([every[:common], every[common + left :]]))
        assert 100 * common >= percent * (common + extra)
        missed += not len(np.intersect1d(signatures(a, Bands(percent)), signatures(b, Bands(percent))))
    assert not missed


def test_components_of_a_long_path(spark):
    edges = [(n, n + 1) for n in range(60) if n != 30] + [(100, 7)]
    random.Random(1).shuffle(edges)
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{n: 0 for n in range(31)}, **{n: 31 for n in range(31, 61)}, 100: 0}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "Short item"), (3, None), (4, "!!"),
         (None, "nobody knows"), (5, "short ITEM"), (6, "a a a a a a a a a a a a")]
TEXTS = [(1, "x ALPHA, beta gamma delta: epsilon zeta eta theta iota kappa y"), (2, "a short--item is short item."), (3, None), (4, ""),
         (5, "shortitem"), (None, "nobody knows"), (6, "a " * 30), (7, "beta gamma delta epsilon zeta eta theta iota kappa lambda é"), (7, "short item")]


@pytest.mark.parametrize("max_bytes", [1 << 20, 30])
def test_contamination(spark, make_docs, max_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.scan(make_docs(TEXTS), items, max_bytes=max_bytes)
    wanted = [(d, n, h, sorted(x for x in names if x is not None)) for (d, _), (n, h, names) in zip(TEXTS, contamination(TEXTS, ITEMS, 10), strict=True)]
    got = [(r.doc_id, r.n_words, r.n_hit, sorted(r["items"])) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    kept = decontaminate.drop_contaminated(make_docs(TEXTS), items, max_bytes=max_bytes)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _, h, _ in wanted if not h)
    assert decontaminate.scan(make_docs([]), items).count() == 0
    assert decontaminate.drop_contaminated(make_docs(TEXTS), items.limit(0)).count() == len(TEXTS)


def test_contamination_places(spark, make_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.scan(make_docs([(1, "é a short--item is\nshort item.")]), items).collect()}
    text = "é a short--item is\nshort item."
    assert [text[s.first : s.last] for s in rows[1].spans] == ["short--item", "short item"]


def word_grams(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return list(zip(*(words[i:] for i in range(5)), strict=False))


def test_licenses_against_every_window(make_docs, hard_rows):
    rng = random.Random(2)
    rows = list(hard_rows)
    for n in range(120):
        _, text = rng.choice(licenses.TEMPLATES)
        words = text.split()
        if n % 3 == 0 and len(words) > 20:
            words[rng.choice([0, -1])] = "changed"
        if n % 5 == 0:
            words = words[: len(words) * 2 // 3]
        rows.append((1000 + n, " ".join(rng.choice(hard_rows[-20:])[1].split()[:40]) + "\n" + " ".join(words).upper() + " end of it"))
    wanted = {}
    for doc, text in rows:
        grams, names = word_grams(text), set()
        for name, template in licenses.TEMPLATES:
            own = set(word_grams(template))
            if any(len(own & set(grams[i : i + len(own)])) >= 0.8 * len(own) for i in range(len(grams))):
                names.add(name)
        wanted.setdefault(doc, []).append(names)
    missed = extra = total = 0
    for r in licenses.find_licenses(make_docs(rows)).collect():
        names = {m.license for m in r.matches}
        best = min(wanted[r.doc_id], key=lambda w: len(w ^ names))
        missed, extra, total = missed + len(best - names), extra + len(names - best), total + len(best)
    assert total > 60 and missed <= 0.01 * total and not extra


def test_license_places_and_bands(make_docs):
    text = "é intro\nLicensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0.\n"
    rows = licenses.find_licenses(make_docs([(1, text), (2, None), (3, "")])).orderBy("doc_id").collect()
    spans = [text.encode()[m.first : m.last].decode() for m in rows[0].matches]
    assert spans and all("Licensed under CC BY-NC 4.0" in s for s in spans) and not rows[1].matches and not rows[2].matches
    assert (1 - 0.5**2) ** licenses.bands_for(0.5, 2, 0.01) <= 0.01
    with pytest.raises(ValueError, match="fewer words"):
        licenses.Index([("x", "too short")])
    assert licenses.find_licenses(make_docs([])).count() == 0


def test_repeated_strings(make_docs, hard_rows):
    rows = [(d, t if t is None or len(t) < 40_000 else t[:20_000]) for d, t in hard_rows]
    rows += [(500, rows[-4][1][:900] + "Q" + rows[-4][1][1200:1700]), (501, "z" * 399), (502, "y" * 400), (503, "w" * 401)]
    found = suffixes.remove_repeats(make_docs(rows))
    got = found.selectExpr("doc_id", "n_bytes", "n_removed", "cast(size(spans) as bigint)", "sha2(kept, 256)")
    wanted = sorted(((d, *x) for (d, _), x in zip(rows, repeats(rows, 400), strict=True)), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == wanted
    assert suffixes.remove_repeats(make_docs([])).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeated_strings_of_few_letters(make_docs, seed):
    """Short thresholds over texts that repeat and overlap themselves."""
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randint(5, 90))) for _ in range(12)]
    rows = [(n, "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))) for n in range(40)]
    found = suffixes.remove_repeats(make_docs(rows), threshold=48, seed=12)
    got = found.selectExpr("doc_id", "n_bytes", "n_removed", "cast(size(spans) as bigint)", "sha2(kept, 256)")
    assert sorted(tuple(r) for r in got.collect()) == sorted((d, *x) for (d, _), x in zip(rows, repeats(rows, 48), strict=True))
