import random

import pyarrow as pa
import pytest

from cleargrain.llm import license_list, licenses, queries


@pytest.fixture(scope="module")
def index():
    return licenses.Index(license_list.full_list())


def names(index, *texts):
    return [sorted({m[0] for m in found}) for found in index.scan(pa.array(texts))]


def test_whole_texts_give_their_own_name(index):
    whole = list(license_list._texts())
    assert {"MIT", "ISC", "Unlicense", "CC0-1.0", "MPL-2.0", "GPL-2.0", "GPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause"} <= {n for n, _ in whole}
    assert names(index, *(f"Before it\n{text}\nafter it" for _, text in whole)) == [[n] for n, _ in whole]
    assert names(index, *(text.upper().replace("\n", " ") for _, text in whole)) == [[n] for n, _ in whole]


def test_sister_licenses_and_versions_apart(index):
    fsf = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
    wanted = {
        "This work is licensed under the GNU General Public License, version 2.": ["GPL-2.0"],
        "This work is licensed under the GNU General Public License, version 3.": ["GPL-3.0"],
        "This work is licensed under the GNU General Public License.": ["GPL"],
        fsf.format("General Public License", 2): ["GPL-2.0"],
        fsf.format("Affero General Public License", 3): ["AGPL-3.0"],
        fsf.format("Lesser General Public License", "2.1"): ["LGPL-2.1"],
        "Licensed under the MIT License.": ["MIT"],
        "Licensed under CC BY-NC 3.0. Released under the MIT License.": ["CC-BY-NC-3.0", "MIT"],
        "SPDX-License-Identifier: LGPL-2.1-or-later": ["LGPL-2.1"],
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at": ["MPL-1.1"],
        "A text about software that names no terms at all, and is not licensed to anybody.": [],
    }
    assert dict(zip(wanted, names(index, *wanted), strict=True)) == wanted


def test_two_licenses_in_one_text(index):
    whole = dict(license_list._texts())
    assert names(index, whole["MIT"] + "\n" + whole["BSD-3-Clause"]) == [["BSD-3-Clause", "MIT"]]
    changed = whole["BSD-3-Clause"].replace("the copyright holder", "Example Widgets Incorporated of Springfield")
    assert names(index, changed) == [["BSD-3-Clause"]]


def test_production_query_scans_for_the_full_list(spark, tmp_path):
    whole = dict(license_list._texts())
    spark.createDataFrame([(1, whole["MPL-2.0"]), (2, whole["ISC"]), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op9_license_scan(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [r.licenses for r in found] == ["MPL-2.0", "ISC", ""]


def stretched_rows(rng, templates, amount):
    """Templates with words inserted, in a text of words of other templates."""
    filler = [w for _, text in templates for w in text.split()]
    rows = []
    for _ in range(amount):
        words = rng.choice(templates)[1].split()
        for _ in range(rng.randint(1, 3)):
            at = rng.choice([len(words) // 2, rng.randrange(1, len(words))])
            words[at:at] = [f"w{rng.random()}" if rng.random() < 0.5 else rng.choice(filler) for _ in range(rng.randint(1, len(words) // 2))]
        around = [[rng.choice(filler) for _ in range(rng.randint(0, 60))] for _ in range(2)]
        rows.append(" ".join(around[0] + words + around[1]))
    return rows


def test_templates_with_inserted_words_against_every_stretch():
    """Any stretch of twice a template's length and two that holds 80 % of its shingles is found."""
    rng = random.Random(4)
    base = [f"t{n}" for n in range(400)]
    templates = [(f"T{n}", " ".join(rng.choice(base) for _ in range(size))) for n, size in enumerate([5, 9, 16, 29, 29, 44, 60, 90, 150, 150])]
    texts = stretched_rows(rng, templates, 500)
    index = licenses.Index(templates, miss=0.005)

    def grams(text):
        words = text.lower().replace(".", " ").split()
        return list(zip(*(words[i:] for i in range(5)), strict=False))

    sets, missed, total = {n: set(grams(t)) for n, t in templates}, 0, 0
    for text, found in zip(texts, index.scan(pa.array(texts)), strict=True):
        own, got = grams(text), {m[0] for m in found}
        for name, wanted in sets.items():
            reach = 2 * (len(wanted) // 2 + 1) + len(wanted)
            if any(len(wanted & set(own[i : i + reach])) >= 0.8 * len(wanted) for i in range(max(1, len(own) - reach + 1))):
                total, missed = total + 1, missed + (name not in got)
    assert total > 200 and missed <= 0.01 * total


def test_bands_follow_from_the_least_similar_window():
    """Just enough of a template in a window whose other shingles are another template's."""
    index = licenses.Index([("A", " ".join(f"a{n}" for n in range(29)))])
    length, rng = 25, random.Random(6)
    least = 20 / (length + index.width(length) - 20)
    assert (1 - least**2) ** index.bands[length] <= 0.005
    found = 0
    for n in range(300):
        other = [f"o{n}x{k}" for k in range(40)]
        both = licenses.Index([("A", " ".join(f"a{n}x{k}" for k in range(29))), ("B", " ".join(other))], seed=rng.randrange(1 << 30))
        words = [f"a{n}x{k}" for k in range(29)]
        words[14:14] = other[:26]
        found += any(m[0] == "A" for m in both.scan(pa.array([" ".join(words)]))[0])
    assert found >= 297
