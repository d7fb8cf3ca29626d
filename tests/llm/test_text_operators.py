"""The text operators against brute force, round trips, the libraries, and odd tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kpiloom.llm import (
    config_packing,
    decontamination,
    exact_dedup,
    language_id,
    licenses,
    near_dedup,
    pii,
    token_counts,
    token_output,
    toxicity,
)
from kpiloom.llm.common import prepared
from kpiloom.llm.encoding import cut_points
from kpiloom.llm.queries import byte_tokenizer

PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, lang string, score string, kept string"
FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    prepared(spark)

    def make(*texts, first=0):
        rows = [(first + i, t, "en", "clash", "clash") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


def by_id(df):
    return {row["doc_id"]: row for row in df.collect()}


ODD = [None, "", " \n\t ", "a", "Ünï ☃   x", "x" * 50_000, "word " * 20_000, "!?!", "\x00\x1f", "same", "same"]


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lower) if w]


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


# near duplicates


def near_texts(seed, originals=6, copies=25):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(originals):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(6, 160))]
        passage = [rng.choice(vocabulary) for _ in range(40)]
        for _ in range(copies):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                copy += passage
            texts.append(rng.choice([" ", "\n", "  "]).join(copy))
    rng.shuffle(texts)
    return [*texts, None, "", "one", "ONE", "one two"]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(docs, seed):
    texts = near_texts(seed)
    expected, sizes = brute_components(texts)
    found = by_id(near_dedup.near_groups(docs(*texts)))
    assert [found[i]["component_id"] for i in range(len(texts))] == expected
    assert [found[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert all(row["kept"] == (row["doc_id"] == row["component_id"]) for row in found.values())


def test_components_of_the_sample_table(spark):
    table = prepared(spark).read.parquet(f"{FOLDER}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect())
    expected, _ = brute_components([t for _, t in rows])
    found = by_id(near_dedup.near_groups(table, broadcast_rows=0))
    assert [found[i]["component_id"] for i, _ in rows] == [rows[k][0] for k in expected]


def test_one_original_with_many_different_copies_makes_few_pairs(spark, docs):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    texts = [" ".join(base)]
    for k in range(300):
        copy = list(base)
        for place in rng.sample(range(120), rng.randint(0, 12)):
            copy[place] = f"x{k}_{place}"
        texts.append(" ".join(copy))
    expected, _ = brute_components(texts)
    found = by_id(near_dedup.near_groups(docs(*texts)))
    assert [found[i]["component_id"] for i in range(len(texts))] == expected
    members = spark.createDataFrame([(i, c) for i, c in enumerate(expected)], "rep long, component long")
    assert near_dedup.pairs_apart(members, docs(*texts), 5, 75, 100).count() < 3 * len(texts)


def test_similarity_of_exactly_three_quarters_is_a_link(docs):
    a = [f"w{k}" for k in range(18)]  # 14 shingles
    b = a[:16] + ["x", "y"]  # 12 shared of 16
    found = by_id(near_dedup.near_groups(docs(" ".join(a), " ".join(b))))
    assert found[1]["component_id"] == 0


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(201, 200), (200, 200)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["component"] for r in near_dedup.components(frame).collect()}
    assert found == {**{k: 0 for k in range(1, 61)}, **{k: 100 for k in range(101, 160)}, 201: 200}


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    common, left, right = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 200, 200))
    sets = [np.unique(np.concatenate((common, side))) for side in (left, right)] + [np.array([7], np.uint64)]
    sketch = near_dedup.sketches(sets, 128)
    assert (sketch != np.iinfo(np.uint64).max).all()
    assert abs((sketch[0] == sketch[1]).mean() - 0.6) < 0.15


# exact duplicates


def brute_groups(texts):
    plain = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for t in texts]
    groups = defaultdict(list)
    for i, t in enumerate(plain):
        groups[t].append(i)
    return {i: (min(groups[t]), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in enumerate(plain)}


@pytest.mark.parametrize("prime, broadcast_rows", [(exact_dedup.PRIME, 500_000), (3, 500_000), (3, 0)])
def test_groups_equal_brute_force_also_when_fingerprints_collide(docs, prime, broadcast_rows):
    rng = random.Random(5)
    texts = [rng.choice(["ab", "ba", "a b", "a\n b", "c", "", None, "dd", " a", "b c d"]) for _ in range(200)]
    texts += ["x" * 70_000 + "a", "x" * 70_000 + "b", "x" * 70_000 + "a"]
    found = by_id(exact_dedup.exact_groups(docs(*texts), prime, broadcast_rows))
    expected = brute_groups(texts)
    assert {i: (r["keep_id"], r["group_size"], r["text_sha256"]) for i, r in found.items()} == expected
    assert all(r["kept"] == (i == r["keep_id"]) for i, r in found.items())


@given(st.binary(max_size=300), st.binary(max_size=300))
def test_fingerprints_compose(a, b):
    base = exact_dedup.BASES[0]
    whole = exact_dedup.chunk_hash(np.frombuffer(a + b, np.uint8), base)
    parts = [(exact_dedup.chunk_hash(np.frombuffer(p, np.uint8), base), len(p)) for p in (a, b)]
    assert exact_dedup.combined(parts, base) == whole


# decontamination


def brute_hits(text, items):
    def split(t):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower) if w]

    w, hit, found = split(text), set(), set()
    for item, item_text in items:
        v = split(item_text)
        size = min(13, len(v))
        grams = {tuple(v[i : i + size]) for i in range(max(0, len(v) - size + 1))} if v else set()
        for i in range(len(w) - size + 1) if grams else ():
            if tuple(w[i : i + size]) in grams:
                hit.update(range(i, i + size))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("letters", [2_000_000, 600])
def test_hits_equal_brute_force_with_one_and_with_many_automata(spark, docs, letters):
    rng = random.Random(7)
    vocabulary = ["a", "b", "C", "d9", "é", "x"]
    passage = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (30, 20, 13, 12, 3, 1)]
    items = [*enumerate(passage), (7, None), (8, "?!"), (9, passage[0]), (9, passage[1]), (None, "x"), (10, "zz zz")]
    texts = [*ODD, *[rng.choice(passage) + " - " + rng.choice(passage).upper() + " y" * rng.randint(0, 300) for _ in range(40)]]
    texts += [" ".join(rng.choice(vocabulary) for _ in range(300)) for _ in range(10)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = by_id(decontamination.contamination(docs(*texts), frame, letters=letters))
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        n_words, n_hit, ids = brute_hits(text, [(k, t) for k, t in items if k is not None])
        row = found[i]
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (n_words, n_hit, len(ids)), text
        assert row["items_sha256"] == decontamination.items_digest(ids)
        assert row["contaminated"] == (n_hit > 0 and 20 * n_hit >= n_words)


def test_hit_spans_point_at_the_original(spark, docs):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    text = "é, " + item.upper().replace(" ", " - ") + "! end"
    frame = spark.createDataFrame([(1, item)], "item_id long, text string")
    row = decontamination.contamination(docs(text), frame).first()
    (span,) = row["spans"]
    assert text[span["start"] : span["end"]] == item.upper().replace(" ", " - ")


# tokens


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t▁ab<s>é☃ａ"), st.characters(codec="utf-8")), max_size=60))
def test_token_counts_equal_the_library(text):
    counts = token_counts.pre_token_counts(PIECES)
    assert counts.of_text(text) == len(counts.model.encode(text))


def test_token_counts_of_odd_texts(docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = by_id(token_counts.token_counts(docs(*ODD), PIECES))
    for i, text in enumerate(ODD):
        n = len(model.encode(text or ""))
        assert (found[i]["n_bytes"], found[i]["n_tokens"]) == (len((text or "").encode()), n)
        assert found[i]["over_limit"] == (n > 4096)


def library_ids(text):
    return [*Tokenizer.from_file(byte_tokenizer()[0]).encode(text or "", add_special_tokens=False).ids, 0]


def test_packing_holds_every_id_without_gaps(docs):
    rng = random.Random(11)
    texts = [*ODD, "a <|endoftext|> b", *["w " * rng.randint(0, 900) for _ in range(150)]]
    rows = config_packing.packed(docs(*texts), byte_tokenizer()).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in enumerate(texts):
        ids = np.array(library_ids(text), "<u4")
        parts = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [(r["start"], r["length"]) for r in parts] == cut_points(len(ids), 2048)
        for r in parts:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(r["length"] for r in rows) // 2048)
    assert len(by_sequence) <= least + 1


def test_plan_holds_the_histogram_in_almost_as_few_sequences_as_can_be():
    rng = random.Random(13)
    histogram = Counter(min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(60_000))
    plan = config_packing.plan_packing(histogram)
    held = Counter()
    for config, times in plan:
        assert sum(n * c for n, c in config) <= 2048
        for n, c in config:
            held[n] += c * times
    assert held == histogram
    least = -(-sum(n * c for n, c in histogram.items()) // 2048)
    assert sum(times for _, times in plan) <= 1.002 * least


def test_grouped_best_fit_equals_one_by_one():
    rng = random.Random(17)
    for _ in range(30):
        lengths = sorted((rng.randint(1, 50) for _ in range(120)), reverse=True)
        rooms = []
        for n in lengths:
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - n)
            else:
                rooms.append(50 - n)
        grouped = config_packing.best_fit_decreasing(Counter(lengths), 50)
        assert sum(grouped.values()) == len(rooms)
        assert Counter({n: sum(t * dict(c).get(n, 0) for c, t in grouped.items()) for n in set(lengths)}) == Counter(lengths)
        assert sorted(len(s) for s in token_output.best_fit(lengths, 50))
        assert len(token_output.best_fit(lengths, 50)) == len(rooms)


def test_matrices_give_every_document_back(docs):
    texts = [*ODD, "tail " * 3000]
    rows = token_output.packed_matrices(docs(*texts), byte_tokenizer(), group_tokens=20_000).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    parts = defaultdict(dict)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == 2048 and not ids[r["cu_seqlens"][-1] :].any()
        places = np.frombuffer(r["position_ids"], "<u2")
        assert places.tolist() == [k for a, b in itertools.pairwise(r["cu_seqlens"]) for k in range(b - a)] + [0] * (2048 - r["cu_seqlens"][-1])
        for doc, piece, a, b in zip(r["doc_ids"], r["pieces"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            parts[doc][piece] = ids[a:b].tolist()
    for i, text in enumerate(texts):
        assert sum((parts[i][k] for k in sorted(parts[i])), []) == library_ids(text)


# personal data

_BASE = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def brute_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(_BASE):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
            luhn = sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
            fits = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and luhn,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if fits:
                found.append((m.start(), order, m.end()))
    return sorted(found)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aB7 01.+-@()%_\né", max_size=50))
def test_base_spans_equal_the_patterns(text):
    assert pii.find_spans(text)[0] == brute_spans(text)


@pytest.mark.parametrize(
    "text, kind, disguised",
    [
        ("mail john.doe [at] mail (dot) org now", "email", "john.doe [at] mail (dot) org"),
        ("john at mail dot org", "email", "john at mail dot org"),
        ("see jоhn@mаil.org!", "email", "jоhn@mаil.org"),
        ("call plus one two zero two five five five zero one two three", "phone", None),
        ("host １０.0.0.1 up", "ip", "１０.0.0.1"),
        ("pay four one one one 1111 1111 1111 by", "card", "four one one one 1111 1111 1111"),
    ],
)
def test_disguises_are_found_at_their_place(text, kind, disguised):
    base, spans = pii.find_spans(text)
    extra = [(pii.KINDS[k], text[a:b]) for a, k, b in spans if (a, k, b) not in base]
    assert [k for k, _ in extra] == [kind]
    if disguised:
        assert extra[0][1] == disguised


@pytest.mark.parametrize(
    "disguised",
    [
        "john at example.com",
        "john AT example.com",
        "max@beispiel punkt de",
        "max at beispiel punkt de",
        "luc at exemple point fr",
        "luc at mail point exemple point fr",
        "ana at ejemplo punto es",
        "ann@mail\tdot\torg",
        "ann at mail\ndot org",
        "ann [at] mail.org",
        "ann@mail (punto) org",
    ],
)
def test_each_disguise_is_found_alone(disguised):
    text = f"Write: {disguised}, now"
    base, spans = pii.find_spans(text)
    assert not base and [(pii.KINDS[k], text[a:b]) for a, k, b in spans] == [("email", disguised)]


@pytest.mark.parametrize(
    "disguised",
    [
        "one nine two dot one six eight dot zero dot one",
        "192.168.zero.one",
        "192.168.0.one",
        "zehn.0.0.1 or 10.zero.0.1",
        "one-nine-two.one, six, eight.zero.one",
        "192 punkt 168 punkt null punkt eins",
    ],
)
def test_spelled_addresses_keep_their_dots(disguised):
    text = f"Port 80, {disguised} is up"
    base, spans = pii.find_spans(text)
    found = [(pii.KINDS[k], text[a:b]) for a, k, b in spans]
    assert not base and found == [("ip", disguised.split(" or ")[-1])]


def test_spelled_cards_with_dots_stay_found():
    assert "card" in [pii.KINDS[k] for _, k, _ in pii.find_spans("four.one.one.one.1111.1111.1111")[1]]


@pytest.mark.parametrize("text", ["We look at this point in time", "it rose at 3.5 percent", "he met at noon. Then", "a dot b at c"])
def test_at_in_prose_is_no_address(text):
    assert pii.find_spans(text) == ([], [])


def test_personal_data_of_odd_texts(docs):
    found = by_id(pii.personal_data(docs(*ODD, "a@b.co a@b.co", "seven one")))
    assert found[0]["base_sha256"] == hashlib.sha256(b"").hexdigest() and found[0]["spans"] == ""
    assert found[len(ODD)]["spans"] == "email:0:6,email:7:13" and found[len(ODD)]["n_email"] == 2
    assert found[len(ODD) + 1]["spans"] == ""


# licences


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Intro.\nReleased under the MIT License.\nMore", ["MIT"]),
        ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
        ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
        ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
        (
            " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted:\n"
            " * Redistributions of source code must retain the above copyright notice.\n"
            " * Redistributions in binary form must reproduce the above copyright notice.\n"
            " * This software is provided by the authors as is and any express or implied warranties are disclaimed.\n",
            ["BSD-2-Clause"],
        ),
        ("We talked about the MIT license today.", []),
        ("Unlicensed work", []),
    ],
)
def test_licences_by_sentence_rules(docs, text, expected):
    row = licenses.license_scan(docs(text)).first()
    assert row["licenses"] == expected


_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated\ndocumentation files (the \"Software\"), to deal in the Software without restriction, subject to the following conditions:\n\n"
_GNU = "This program is free software{sign} you can redistribute it and/or modify\nit under the terms of the GNU {name}General Public License as published by\nthe Free Software Foundation{either} either version {n} of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details.\n"
_BSD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer.\n{third}\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\"\nAND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, ARE DISCLAIMED.\n"
_APACHE = "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License.\n"
NOTICES = {
    "MIT": _MIT_GRANT + "The above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY.\n",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES\nWITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES.\n",
    "BSD-2-Clause": _BSD.format(third=""),
    "BSD-3-Clause": _BSD.format(third="3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n"),
    "Apache-2.0": _APACHE,
    "GPL-2.0-or-later": _GNU.format(sign=";", name="", either=";", n=2),
    "LGPL-2.1-or-later": _GNU.format(sign=";", name="Lesser ", either=";", n=2.1),
    "AGPL-3.0-or-later": _GNU.format(sign=":", name="Affero ", either=",", n=3),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.\n",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy.\n",
}


@pytest.mark.parametrize("comment", ["", " * ", "# "])
@pytest.mark.parametrize("licence", sorted(NOTICES))
def test_whole_notices_match_their_rule(licence, comment):
    notice = "Copyright 2020 A. Person\n\n" + NOTICES[licence]
    text = "\n".join((comment + line).rstrip() for line in notice.split("\n")) + "\nint main() { return 0; }\n"
    assert licenses.scan(text)[1] == [licence]
    kinds = [name.partition(":")[0] for name in licenses.sentence_ids(text)]
    rules = [rule for name, rule in licenses.RULES if name in (licence, None) and set(rule) <= set(kinds)]
    assert [kind for kind in kinds if kind in max(rules, key=len)] == list(max(rules, key=len))


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Released under the MIT License, see LICENSE.", ["MIT"]),
        ("This tool is licensed under the GPL version 2 or later.", ["GPL-2.0-or-later"]),
        ("Licensed under the GNU General Public License v. 3 or any later version", ["GPL-3.0-or-later"]),
        ("Licensed under the Apache License 2.0; see below", ["Apache-2.0"]),
        ("Licensed under CC BY-NC-SA 4.0, see the page.", ["CC-BY-NC-SA-4.0"]),
        ("Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License by us", ["CC-BY-SA-4.0"]),
        ("Licensed under CC BY 4.0 by the authors", ["CC-BY-4.0"]),
        ("Licensed under the AGPL version 1", []),
        ("Licensed under the Apache License 1.1", []),
        ("Licensed under the GPL 21", []),
        ("Note: this is free software; ask us: licences follow", []),
    ],
)
def test_references_may_go_on(text, expected):
    assert licenses.scan(text)[1] == expected


def test_rules_need_their_order():
    assert licenses.match_rules([(0, "MIT-GRANT"), (1, "MIT-NOTICE"), (2, "AS-IS-SOFTWARE")]) == ["MIT"]
    assert licenses.match_rules([(0, "AS-IS-SOFTWARE"), (1, "MIT-NOTICE"), (2, "MIT-GRANT")]) == []


# learned operators


def test_language_on_held_out_rows(spark):
    table = prepared(spark).read.parquet(f"{FOLDER}/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    found = language_id.language_id(table, held_out).join(table.select("doc_id", "lang"), "doc_id")
    rows = found.join(table.select("doc_id", held_out.alias("held")), "doc_id").where("held").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_texts_and_without_rows(spark, docs):
    frame = docs(*ODD).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("fr"))
    found = by_id(language_id.language_id(frame, F.lit(False)))
    assert [found[i]["lang_pred"] == "und" for i in range(len(ODD))] == [
        not any(c.isalpha() for c in t or "") for t in ODD
    ]
    nothing = by_id(language_id.language_id(frame, F.lit(True)))
    assert {r["lang_pred"] for r in nothing.values()} == {"und"}


def test_toxicity_on_held_out_rows(spark):
    table = prepared(spark).read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = by_id(toxicity.toxicity(table, labels, ~held_out))
    rows = labels.where(held_out).collect()
    assert np.mean([found[r["doc_id"]]["predicted"] == r["toxic"] for r in rows]) > 0.95


def test_disguised_words_count_like_plain_ones(spark, docs):
    rng = random.Random(19)
    clean = ["the", "house", "stone", "water", "garden", "letter", "people", "moment"]
    texts = [" ".join(rng.choice(clean) for _ in range(30)) + ("" if k % 3 else " stupid" if k % 2 else " moron") for k in range(300)]
    frame = docs(*texts)
    labels = spark.createDataFrame([(k, int(k % 3 == 0), 9) for k in range(300)], "doc_id long, toxic int, text int")
    model = toxicity.fit(frame, labels, F.lit(True))
    tests = ["you 5tup1d thing", "a m0r0n", "s t u p i d", "stuuupid moron!!!", "s.t.u.p.i.d", "the stone house", None, ""]
    found = by_id(toxicity.scored(docs(*tests), model))
    assert [found[k]["predicted"] for k in range(len(tests))] == [1, 1, 1, 1, 1, 0, 0, 0]


# Costs under which each word of these texts is the cheapest reading of its disguises.
_READ = ["the stupid moron and asshole dumbass idiot", "a stupid fucking dumbass of an asshole", "idiot moron stupid letter"]


def read_costs():
    total = Counter()
    for text in _READ:
        code = [0, 0, *(toxicity._INDEX.get(c, 0) for c in text), 0]
        total.update((a * toxicity._SIZE + b) * toxicity._SIZE + c for a, b, c in zip(code, code[1:], code[2:]))
    return toxicity.language_costs(np.array([*total]), np.array([*total.values()]))


def scorer_of(costs):
    words = {w for text in _READ for w in text.split()}
    features = sorted(toxicity._of_words(sorted(words)))
    return toxicity.Scorer(toxicity.ToxicityModel(costs, {f: 1.0 for f in features}))


def scored_features(scorer, text):
    scorer.score(text)
    return {f for token in text.lower().split() for f in scorer.known[token]}


@pytest.mark.parametrize(
    "word", ["\u0455tupid", "\u0455tup\u0456d", "m\u043er\u043en", "\u0430sshole", "\u03b9diot", "stupid", "5tupid", "stuuupid", "house", "\u0436\u0436"]
)
def test_scorer_finds_the_features_that_fit_counts(word):
    costs = read_costs()
    scorer = scorer_of(costs)
    expected = {f for f in toxicity.features_of(word, costs) if f in scorer.model.weights}
    assert scored_features(scorer, word) == expected
    plain = word.translate(str.maketrans("\u0455\u0456\u043e\u0430\u03b9", "sioai"))
    assert (plain + " " in expected) == (plain in " ".join(_READ).split())


@pytest.mark.parametrize(
    "token, word",
    [
        ("dumba$$", "dumbass"),
        ("dumba$$!", "dumbass"),
        ('"dumba$$",', "dumbass"),
        ("@$$hole", "asshole"),
        ("(@$$hole)", "asshole"),
        ("stuupid", "stupid"),
        ("stupidd.", "stupid"),
        ("stu-pid", "stupid"),
        ("id.iot", "idiot"),
        ("mor'on...", "moron"),
        ("!diot", "idiot"),
        ("f***ing", None),
        ("letter!!", "letter"),
        ("house?!", None),
        ("10.5", None),
    ],
)
def test_signs_around_and_inside_a_word_reach_the_lattice(token, word):
    costs = read_costs()
    found = toxicity.features_of(token, costs)
    assert word is None or word + " " in found
    scorer = scorer_of(costs)
    assert scored_features(scorer, token) == {f for f in found if f in scorer.model.weights}


def test_signs_at_the_end_of_a_word_are_read():
    costs = read_costs()
    (core,) = {c for c in toxicity._cores("f***") if c != "f"}
    assert core == "f***" and toxicity.restored(core, costs).strip() != "f"
    assert toxicity._cores("@$$") == {"@$$"} and not toxicity._cores("!!!") and not toxicity._cores("1990")


@pytest.mark.parametrize("before", range(18, 34))
def test_words_of_long_runs_are_read_wherever_they_are(before):
    costs = read_costs()
    spaced = " ".join("thehouseis"[k % 10] for k in range(before)) + " - s t u p i d - " + " ".join("letter" * 9)
    assert "stupid" in toxicity.restored(spaced, costs)
    token = "the." * (before // 2) + "5tup1d." + "a.stone." * 20
    assert "stupid" in toxicity.restored(token, costs)


def cheapest(observed, costs):
    """Cost and text of all readings, one by one."""
    size = toxicity._SIZE
    signs = [toxicity._readings(c, k > 0 and observed[k - 1] == c) for k, c in enumerate(observed)]
    for reading in itertools.product(*signs):
        a = b = 0
        cost = sum(channel for _, channel in reading)
        for letter, _ in reading:
            code = toxicity._INDEX.get(letter, 0)
            if letter and (code or b):
                cost += costs[(a * size + b) * size + code]
                a, b = b, code
        cost += costs[(a * size + b) * size] if b else 0.0
        yield cost, "".join(letter for letter, _ in reading)


@pytest.mark.parametrize("observed", ["*#%&1d", "st*#%1", "1!|6*&", "&&*#!1", "a**1!%", "s-t*-#1"])
def test_no_state_of_the_lattice_is_left_out(observed):
    costs = read_costs()
    readings = sorted(cheapest(observed, costs))
    best = {"".join(read.split()) for cost, read in readings if cost < readings[0][0] + 1e-9}
    assert "".join(toxicity.restored(observed, costs).split()) in best


@given(st.text(alphabet="abilstup$@!*.-_'1ж\u0455 ", max_size=12))
def test_scorer_and_fit_read_the_same(text):
    costs = read_costs()
    scorer = scorer_of(costs)
    found = {f for f in toxicity.features_of(text, costs) if f in scorer.model.weights}
    spaced = set(toxicity._spaced_out(text.lower(), costs)) & found
    assert scored_features(scorer, text) | spaced == found


def test_toxicity_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    found = by_id(toxicity.toxicity(docs(*ODD), labels, F.lit(True)))
    assert {r["predicted"] for r in found.values()} == {0}


# tables


OPERATORS = {
    "language": lambda spark, df: language_id.language_id(df, F.lit(False)),
    "near": lambda spark, df: near_dedup.near_groups(df),
    "licence": lambda spark, df: licenses.license_scan(df),
    "toxicity": lambda spark, df: toxicity.toxicity(df, spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True)),
    "matrices": lambda spark, df: token_output.packed_matrices(df, byte_tokenizer()),
    "counts": lambda spark, df: token_counts.token_counts(df, PIECES),
    "contamination": lambda spark, df: decontamination.contamination(
        df, spark.createDataFrame([], "item_id long, text string")
    ),
    "packing": lambda spark, df: config_packing.packed(df, byte_tokenizer()),
    "personal": lambda spark, df: pii.personal_data(df),
    "exact": lambda spark, df: exact_dedup.exact_groups(df),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_tables_and_repeated_rows(spark, docs, name):
    run = OPERATORS[name]
    assert run(spark, docs("a").limit(0)).count() == 0
    twice = docs(*ODD).unionAll(docs(*ODD))
    found = run(spark, twice)
    if name == "matrices":
        assert Counter(d for r in found.collect() for d, p in zip(r["doc_ids"], r["pieces"]) if p == 0) == {
            i: 2 for i in range(len(ODD))
        }
    else:
        one_each = found.where("piece = 0") if name == "packing" else found
        assert Counter(r["doc_id"] for r in one_each.collect()) == {i: 2 for i in range(len(ODD))}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_rows_without_an_id(spark, docs, name):
    frame = docs("a b c d e f g", "same", None).unionAll(docs("a b c d e f g", "x y", "same", "").withColumn("doc_id", F.lit(None).cast("long")))
    found = OPERATORS[name](spark, frame).collect()
    if name == "matrices":
        assert Counter(d for r in found for d in r["doc_ids"]) == {0: 1, 1: 1, 2: 1, None: 4}
    else:
        assert Counter(r["doc_id"] for r in found) == {0: 1, 1: 1, 2: 1, None: 4}
    if name in ("near", "exact"):
        assert {r["doc_id"]: r["kept"] for r in found} == {0: True, 1: True, 2: True, None: None}
    if name == "exact":
        assert {r["doc_id"]: r["group_size"] for r in found if r["doc_id"] is not None} == {0: 2, 1: 2, 2: 2}


@pytest.mark.parametrize("letters", [10**6, 40])
def test_decontaminated_decides_each_row_by_its_text(spark, docs, letters):
    passage = " ".join(f"p{k}" for k in range(20))
    items = spark.createDataFrame([(1, passage), (2, "short item"), (3, " ".join(f"q{k}" for k in range(15)))], "item_id long, text string")
    texts = [passage, "nothing here", None, "", "a short item", passage + " and " + "more " * 500, "q1 q2 q3"]
    rows = docs(*texts)
    frame = rows.unionAll(rows.withColumn("doc_id", F.lit(None).cast("long"))).unionAll(docs("nothing here", passage, first=0))
    frame = frame.withColumn("row", F.lit("clash")).withColumn("words", F.lit(1))
    kept = decontamination.decontaminated(frame, items, letters=letters)
    assert kept.columns == frame.columns
    clean = ["nothing here", None, "", passage + " and " + "more " * 500, "q1 q2 q3"]
    assert Counter(r["text"] for r in kept.collect()) == {**{t: 2 for t in clean}, "nothing here": 3}
