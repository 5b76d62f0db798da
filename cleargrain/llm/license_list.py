"""The license texts and notices that the production query scans for.

Whole texts lie in ``license_texts``, one file a license, without the lines that name an owner.
Notices are the sentences, titles, addresses and SPDX lines by which a license is usually named,
one a version, so that sister licenses and versions stand beside each other and the best can be
told. A name without a version stands for a notice that gives none. Notices of fewer than five
words (``SPDX-License-Identifier: MIT``) can't be scanned for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from importlib import resources

#: Words of a shingle; shorter notices are left out.
LEAST_WORDS = 5

_LEADS = (
    "Licensed under the {}", "Released under the {}", "Distributed under the {}", "Available under the {}", "Published under the {}",
    "under the terms of the {}", "Licensed under {}", "Released under {}", "Distributed under {}",
)

#: License family, its full names, and its versions.
_FAMILIES = (
    ("GPL", ("GNU General Public License",), ("1.0", "2.0", "3.0")),
    ("LGPL", ("GNU Lesser General Public License",), ("2.1", "3.0")),
    ("LGPL", ("GNU Library General Public License",), ("2.0",)),
    ("AGPL", ("GNU Affero General Public License",), ("3.0",)),
    ("GFDL", ("GNU Free Documentation License",), ("1.1", "1.2", "1.3")),
    ("Apache", ("Apache License", "Apache Software License"), ("1.0", "1.1", "2.0")),
    ("MPL", ("Mozilla Public License",), ("1.0", "1.1", "2.0")),
    ("EPL", ("Eclipse Public License",), ("1.0", "2.0")),
    ("EUPL", ("European Union Public Licence", "EUPL"), ("1.0", "1.1", "1.2")),
    ("CDDL", ("Common Development and Distribution License",), ("1.0", "1.1")),
    ("BSL", ("Boost Software License",), ("1.0",)),
    ("OFL", ("SIL Open Font License",), ("1.0", "1.1")),
    ("Artistic", ("Artistic License",), ("1.0", "2.0")),
    ("AFL", ("Academic Free License",), ("2.1", "3.0")),
    ("OSL", ("Open Software License",), ("2.1", "3.0")),
    ("ECL", ("Educational Community License",), ("1.0", "2.0")),
    ("PSF", ("Python Software Foundation License",), ("2.0",)),
)

#: Short names by which a license is told, with their versions where they have any.
_SHORT = (
    ("GPL-1.0", ("GNU GPL v1", "GNU GPL version 1")), ("GPL-2.0", ("GPL v2", "GPLv2 license", "GNU GPL v2", "GNU GPL version 2", "GPL 2.0")),
    ("GPL-3.0", ("GPL v3", "GPLv3 license", "GNU GPL v3", "GNU GPL version 3", "GPL 3.0")), ("LGPL-2.1", ("LGPL v2.1", "GNU LGPL v2.1", "LGPL 2.1")),
    ("LGPL-3.0", ("LGPL v3", "GNU LGPL v3", "LGPL 3.0")), ("AGPL-3.0", ("AGPL v3", "AGPLv3 license", "GNU AGPL v3", "AGPL 3.0")),
    ("Apache-2.0", ("Apache 2.0", "Apache 2.0 license", "Apache v2")), ("MPL-1.1", ("MPL 1.1",)), ("MPL-2.0", ("MPL 2.0",)), ("EPL-1.0", ("EPL 1.0",)), ("EPL-2.0", ("EPL 2.0",)),
    ("MIT", ("MIT License", "MIT/X11 License")), ("MIT-0", ("MIT-0 License", "MIT No Attribution License")), ("ISC", ("ISC License",)),
    ("0BSD", ("0BSD License", "BSD Zero Clause License", "Zero-Clause BSD License")), ("BSD", ("BSD License",)),
    ("BSD-2-Clause", ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "Revised BSD License")),
    ("BSD-4-Clause", ("BSD 4-Clause License", "4-Clause BSD License", "Original BSD License")),
    ("Zlib", ("zlib License", "zlib/libpng License")), ("Unlicense", ("Unlicense license",)), ("BSL-1.0", ("Boost License 1.0",)),
    ("WTFPL", ("WTFPL License", "Do What The Fuck You Want To Public License")), ("NCSA", ("University of Illinois/NCSA Open Source License", "NCSA License")),
    ("BlueOak-1.0.0", ("Blue Oak Model License 1.0.0",)), ("CC0-1.0", ("CC0 1.0 Universal", "CC0 1.0 Universal license", "CC0 1.0", "Creative Commons Zero v1.0 Universal")),
)

_CREATIVE = {
    "BY": ("Attribution",), "BY-SA": ("Attribution-ShareAlike", "Attribution-Share Alike"),
    "BY-NC": ("Attribution-NonCommercial", "Attribution-Non-Commercial"),
    "BY-ND": ("Attribution-NoDerivatives", "Attribution-NoDerivs", "Attribution-No Derivative Works"),
    "BY-NC-SA": ("Attribution-NonCommercial-ShareAlike", "Attribution-Noncommercial-Share Alike"),
    "BY-NC-ND": ("Attribution-NonCommercial-NoDerivatives", "Attribution-NonCommercial-NoDerivs"),
}

_REDISTRIBUTE = "is free software: you can redistribute it and/or modify it under the terms of the {} as published by the Free Software Foundation"

#: Sentences of a license's own, as its text tells authors to use them, and opening passages.
_OWN = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
                   "with the License. You may obtain a copy of the License at"),
    ("MPL-1.1", 'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this '
                "file except in compliance with the License. You may obtain a copy of the License at"),
    ("MPL-1.0", 'The contents of this file are subject to the Mozilla Public License Version 1.0 (the "License"); you may not use this '
                "file except in compliance with the License. You may obtain a copy of the License at"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at"),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("CDDL", "The contents of this file are subject to the terms of the Common Development and Distribution License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at"),
    ("MIT", "https://opensource.org/licenses/MIT"), ("MIT", "http://www.opensource.org/licenses/mit-license.php"),
    ("Apache-2.0", "www.apache.org/licenses/LICENSE-2.0"), ("MPL-2.0", "https://mozilla.org/MPL/2.0/"),
    ("CC0-1.0", "creativecommons.org/publicdomain/zero/1.0"),
    ("BSD-3-Clause", "opensource.org/licenses/BSD-3-Clause"), ("BSD-2-Clause", "opensource.org/licenses/BSD-2-Clause"),
)


def _versions(version: str) -> tuple[str, ...]:
    """How a notice writes a version: ``3.0`` also as ``3``."""
    return (version, version[:-2]) if version.endswith(".0") else (version,)


def words_of(text: str) -> tuple[str, ...]:
    return tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()))


def _led(name: str, told: str) -> Iterator[tuple[str, str]]:
    """A name by itself if it is long enough, or after the usual words."""
    if len(words_of(told)) >= LEAST_WORDS:
        yield name, told
    else:
        yield from ((name, lead.format(told)) for lead in _LEADS)


def _notices() -> Iterator[tuple[str, str]]:
    for family, names, versions in _FAMILIES:
        for name in names:
            for lead in ("{}", *_LEADS):
                if lead != "{}":
                    yield family, lead.format(name)
                for version in versions:
                    for told in _versions(version):
                        for form in ("{} version {}", "{} v{}", "{} v. {}", "{} {}"):
                            yield f"{family}-{version}", lead.format(form.format(name, told))
            if family in ("GPL", "LGPL", "AGPL"):
                yield family, _REDISTRIBUTE.format(name)
                for version in versions:
                    for told in _versions(version):
                        for form in ("{}, either version {} of the License, or (at your option) any later version", "{}; version {} of the License", "{}, version {}"):
                            yield f"{family}-{version}", form.format(_REDISTRIBUTE.format(name), told)
    for name, short in _SHORT:
        for told in short:
            yield from _led(name, told)
    for kind, names in _CREATIVE.items():
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            name = f"CC-{kind}-{version}"
            yield name, f"creativecommons.org/licenses/{kind.lower()}/{version}"
            yield from _led(name, f"CC {kind} {version}")
            for long in names:
                yield name, f"Creative Commons {long} {version}"
                for place in ("International", "Unported", "Generic"):
                    yield name, f"This work is licensed under a Creative Commons {long} {version} {place} License"
    for family, short, versions in (("GPL", "gpl", ("1.0", "2.0", "3.0")), ("LGPL", "lgpl", ("2.0", "2.1", "3.0")), ("AGPL", "agpl", ("3.0",)), ("GFDL", "fdl", ("1.2", "1.3"))):
        for version in versions:
            yield f"{family}-{version}", f"www.gnu.org/licenses/{short}-{version}"
    yield from _OWN


def _texts() -> Iterator[tuple[str, str]]:
    for file in sorted(resources.files("cleargrain.llm").joinpath("license_texts").iterdir(), key=lambda x: x.name):
        if file.name.endswith(".txt"):
            yield file.name.removesuffix(".txt").replace("_", " "), file.read_text(encoding="utf-8")


def full_list() -> tuple[tuple[str, str], ...]:
    """(name, text) of every template, equal ones once."""
    named = [*_notices(), *_texts()]
    named += [(name, f"SPDX-License-Identifier: {name}") for name in sorted({name for name, _ in named}) if re.search(r"\d", name)]
    out: dict[tuple[str, tuple[str, ...]], tuple[str, str]] = {}
    for name, text in named:
        if len(words := words_of(text)) >= LEAST_WORDS:
            out.setdefault((name, words), (name, text))
    return tuple(out.values())
