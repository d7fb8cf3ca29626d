"""Licence scans: versions, denied references, rules against brute force, linear time."""

import itertools
import random
import time

import pytest

from kpiloom.llm import licenses
from kpiloom.llm.common import prepared

ZLIB = (
    "This software is provided 'as-is', without any express or implied\nwarranty.  In no event will the authors be held liable.\n\n"
    "1. The origin of this software must not be misrepresented; you must not\n   claim that you wrote the original software.\n"
    "2. Altered source versions must be plainly marked as such, and must not be\n   misrepresented as being the original software.\n"
    "3. This notice may not be removed or altered from any source distribution.\n"
)
BOOST = (
    "Permission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software and accompanying "
    "documentation covered by\nthis license (the \"Software\") to use, reproduce it.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY "
    "OF ANY KIND, EXPRESS OR\nIMPLIED.\n"
)
ZERO = (
    "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.\n\n"
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES.\n"
)


@pytest.mark.parametrize(
    "text, expected",
    [
        (ZLIB, ["Zlib"]),
        (BOOST, ["BSL-1.0"]),
        (ZERO, ["0BSD"]),
        ("Released under GPLv3+.", ["GPL-3.0-or-later"]),
        ("Released under the GPL\n2020 Someone", ["GPL"]),
        ("Distributed under the LGPL-2.1-only", ["LGPL-2.1-only"]),
        ("Licensed under the GNU Library General Public License v2 or (at your option) any later version", ["LGPL-2.0-or-later"]),
        ("made available under the terms of the Eclipse Public License 2.0 which is", ["EPL-2.0"]),
        (
            "Licensed under the EUPL, Version 1.2 or – as soon they will be approved by the Commission – subsequent versions",
            ["EUPL-1.2-or-later"],
        ),
        ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"]),
        ("It is released under the zlib license", ["Zlib"]),
        ("Licensed under the Artistic License 2.0", ["Artistic-2.0"]),
        ("Released under CC0 1.0 Universal", ["CC0-1.0"]),
        ("Released under CC BY-SA-NC 2.5", ["CC-BY-NC-SA-2.5"]),
        ("Licensed under a Creative Commons Attribution-NoDerivatives 3.0 License", ["CC-BY-ND-3.0"]),
        ("Licensed under either of Apache License, Version 2.0 or MIT license at your option", ["Apache-2.0", "MIT"]),
        ("Not licensed under the MIT License.", []),
        ("It has never been released under the GPL version 2", []),
        ("The text is no longer available under CC BY 4.0", []),
        ("This is not only licensed under the MIT License", ["MIT"]),
        ("Do not copy. Licensed under the MIT License", ["MIT"]),
        ("Licensed under the MPL 3.5", []),
        ("He was under the impression that the MIT license applies", []),
        ("", []),
        (None, []),
    ],
)
def test_licences(spark, text, expected):
    assert licenses.scan(text or "")[1] == expected
    row = licenses.license_scan(prepared(spark).createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["licenses"] == expected and not row["unmatched"]


def test_declared_expressions():
    text = "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nand more"
    assert licenses.scan(text)[2] == ["Apache-2.0", "GPL-2.0-only WITH Classpath-exception-2.0", "MIT"]
    assert licenses.scan("// SPDX-License-Identifier: MIT\n// spdx-license-identifier: MIT or so")[2] == ["MIT"]


def test_sentences_of_a_rule_stand_together():
    names = ("MIT-GRANT", "MIT-NOTICE", "AS-IS-SOFTWARE")
    near = [(k * licenses.GAP, name) for k, name in enumerate(names)]
    assert licenses.match_rules(near) == ["MIT"]
    assert licenses.match_rules([*near[:2], (2 * licenses.GAP + 1, names[2])]) == []
    text = "{}\n" + "A sentence. " * 30 + "\n{}"
    apart = text.format("This program is distributed in the hope that it will be useful, but without any warranty", "x")
    assert licenses.scan(apart) == (["GNU-HOPE"], [], [])


def by_brute_force(kinds, rule, gap):
    """The occurrence that ends first, its sentences as late as possible, then those after its end."""
    found, start = [], 0
    while True:
        chains = [
            chain
            for chain in itertools.combinations(range(start, len(kinds)), len(rule))
            if all(kinds[i][1] == kind for i, kind in zip(chain, rule))
            and all(kinds[b][0] - kinds[a][0] <= gap for a, b in itertools.pairwise(chain))
        ]
        if not chains:
            return found
        end = min(chain[-1] for chain in chains)
        best = max((chain for chain in chains if chain[-1] == end), key=lambda chain: chain[::-1])
        found.append([kinds[i][2] for i in best])
        start = end + 1


def test_occurrences_equal_brute_force():
    rng, seen = random.Random(11), 0
    for _ in range(1500):
        numbers = sorted(rng.randrange(30) for _ in range(rng.randrange(14)))
        kinds = [(number, rng.choice("ABCx"), 100 + i) for i, number in enumerate(numbers)]
        rule = tuple("ABC"[: rng.randrange(1, 4)])
        gap = rng.choice([0, 2, 5, 30])
        expected = by_brute_force(kinds, rule, gap)
        seen += len(expected) > 1
        assert licenses.occurrences(kinds, rule, gap) == expected
    assert seen > 100


def test_every_known_sentence_has_a_hint():
    for _, pattern in licenses.SENTENCES:
        plain = pattern.replace("(?: or)?", "").replace(licenses._SOME, " x")
        assert any(hint in plain for hint in licenses._HINTS), pattern


@pytest.mark.parametrize(
    "text",
    [
        "Released under the MIT License. " * 8000, "Released under the MIT License, " * 8000, "neither the name of a " * 8000,
        "licensed a b c d " * 8000, "not be " * 20_000 + "licensed", "permission is hereby granted " * 8000,
        "this software is provided by x as is " * 8000, " \n" * 20_000 + "licence", "licence " + ". " * 20_000,
        "spdx-license-identifier: " + "MIT OR " * 20_000, "licensed under GPL " + "or GPL " * 8000,
        "licence " + "*" * 50_000 + "\n" + "/" * 50_000, "licence " + " " * 50_000 + "x", "licensed under GPL 2 or as soon " * 8000,
    ],
)
def test_linear_time(text):
    start = time.perf_counter()
    licenses.scan(text)
    assert time.perf_counter() - start < 2
