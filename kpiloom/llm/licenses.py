"""Licence scans by sentence rules.

A text is cut into paragraphs and these into sentences over their lines, which
are normalised and searched for known licence sentences.  A known sentence has
a kind, such as ``MIT-GRANT``, or a kind and a licence with its version, such as
``REF:GPL-3.0-or-later`` for a reference.  The sequence of identifiers is then
matched against ordered rules: a rule names kinds that must follow each other
in this order, few sentences apart, longer rules first, and uses up the
sentences it matches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from kpiloom.llm.common import texts

# Some words between two parts of a known sentence.
_SOME = r"(?: [\w.]+){1,40}?"
# Known licence sentences, as patterns over normalised sentences
# (lower case, signs as one space; dots only inside numbers), and their kinds.
SENTENCES = (
    ("MIT-GRANT", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("MIT-NOTICE", r"the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    ("AS-IS-SOFTWARE", r"the software is provided as is without warranty of any kind"),
    ("ISC-AS-IS", rf"the software is provided as is and{_SOME} disclaims? all warranties"),
    ("ISC-GRANT", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("0BSD-GRANT", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted(?! provided)"),
    ("BSD-REDIST", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("BSD-SOURCE", r"redistributions of source code must retain the above copyright notice"),
    ("BSD-BINARY", r"redistributions in binary form must reproduce the above copyright notice"),
    ("BSD-NAME", rf"neither the name{_SOME} may be used to endorse or promote products"),
    ("BSD-AS-IS", rf"this software is provided by{_SOME} as is and any express or implied warranties"),
    ("APACHE-2-FILE", r"you may not use this file except in compliance with the license"),
    ("APACHE-2-AS-IS", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("GNU-HOPE", r"is distributed in the hope that it will be useful but without any warranty"),
    ("UNLICENSE", r"this is free and unencumbered software released into the public domain"),
    ("ZLIB-AS-IS", r"this software is provided as is without any express or implied warranty"),
    ("ZLIB-ORIGIN", r"the origin of this software must not be misrepresented"),
    ("ZLIB-ALTERED", r"altered source versions must be plainly marked as such"),
    ("ZLIB-NOTICE", r"this notice may not be removed or altered from any source distribution"),
    ("BSL-GRANT", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("ALL-RIGHTS", r"all rights reserved"),
)
# Sentences that go on with a licence by name, and their kinds.
_LICENSED = r"(?:licen[sc]ed|released|distributed|available|provided|published|covered|redistributed|offered|governed)"
LEADS = (
    ("REF", rf"{_LICENSED}(?: [\w.]+){{0,4}} under(?: the)?(?: terms of)?(?: either(?: of)?)?(?: the| a)?"),
    ("FREE", r"is free software you can redistribute it and or modify it under the terms of(?: the)?"),
    ("FORM", r"this source code form is subject to the terms of the"),
)
# Words before a reference that deny it.
DENIED = r"(?:not|never|no longer|isn t|aren t|wasn t|weren t|nor|cannot be)(?: (?:be|been|being|yet|currently|itself|longer|to|is|are|necessarily|also|freely))*"
_LIC = r" licen[sc]e"
# Licences by name, their patterns, and the versions they are known in (none: no version is read).
NAMES = (
    ("MIT", rf"(?:mit|expat){_LIC}", ()),
    ("Apache", rf"(?:apache(?: software)?{_LIC}|apache(?= v?[0-9]| version))", ("2.0",)),
    ("LGPL", rf"(?:gnu )?(?:(?:lesser|library) (?:general public{_LIC}|gpl)|lgpl(?=v[0-9])|lgpl\b)", ("2.0", "2.1", "3.0")),
    ("AGPL", rf"(?:gnu )?(?:affero (?:general public{_LIC}|gpl)|agpl(?=v[0-9])|agpl\b)", ("3.0",)),
    ("GPL", rf"(?:gnu )?(?:general public{_LIC}|gpl(?=v[0-9])|gpl\b)", ("1.0", "2.0", "3.0")),
    ("0BSD", rf"(?:0bsd|bsd zero clause|zero clause bsd)(?:{_LIC})?", ()),
    ("BSD-2-Clause", rf"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd)(?:{_LIC})?", ()),
    ("BSD-3-Clause", rf"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd)(?:{_LIC})?", ()),
    ("MPL", rf"(?:mozilla public{_LIC}|mpl(?=v[0-9])|mpl\b)", ("1.0", "1.1", "2.0")),
    ("EPL", rf"(?:eclipse public{_LIC}|epl(?=v[0-9])|epl\b)", ("1.0", "2.0")),
    ("EUPL", rf"(?:european union public licen[sc]e|eupl(?=v[0-9])|eupl\b)", ("1.0", "1.1", "1.2")),
    ("Artistic", rf"(?:perl )?artistic{_LIC}", ("1.0", "2.0")),
    ("BSL", rf"boost software{_LIC}", ("1.0",)),
    ("Zlib", rf"zlib(?: libpng)?{_LIC}", ()),
    ("ISC", rf"isc{_LIC}", ()),
    ("Unlicense", r"unlicense", ()),
    ("CC0", r"(?:creative commons )?(?:cc0|(?:cc|creative commons) zero)(?:(?= 1\.0)| universal|\b)", ("1.0",)),
    ("CC-BY", r"(?:cc|creative commons) (?:by|attribution)", ("1.0", "2.0", "2.5", "3.0", "4.0")),
)
# Further conditions of a Creative Commons licence, in the order of its name.
CONDITIONS = (("NC", r"(?:nc|non ?commercial)"), ("ND", r"(?:nd|no ?deriv\w*)"), ("SA", r"(?:sa|share ?alike)"))
# Licences as ordered kinds; without a licence it is the one that the first sentence names.
RULES = (
    ("BSD-3-Clause", ("BSD-REDIST", "BSD-SOURCE", "BSD-BINARY", "BSD-NAME", "BSD-AS-IS")),
    ("BSD-2-Clause", ("BSD-REDIST", "BSD-SOURCE", "BSD-BINARY", "BSD-AS-IS")),
    ("Zlib", ("ZLIB-AS-IS", "ZLIB-ORIGIN", "ZLIB-ALTERED", "ZLIB-NOTICE")),
    ("MIT", ("MIT-GRANT", "MIT-NOTICE", "AS-IS-SOFTWARE")),
    (None, ("REF", "APACHE-2-FILE", "APACHE-2-AS-IS")),
    ("BSL-1.0", ("BSL-GRANT", "AS-IS-SOFTWARE")),
    ("ISC", ("ISC-GRANT", "ISC-AS-IS")),
    ("ISC", ("ISC-GRANT", "AS-IS-SOFTWARE")),
    ("0BSD", ("0BSD-GRANT", "ISC-AS-IS")),
    (None, ("FREE", "GNU-HOPE")),
    (None, ("FREE",)),
    (None, ("FORM",)),
    (None, ("REF",)),
    ("Unlicense", ("UNLICENSE",)),
)
# Two sentences of one rule have at most so many sentences from one to the next.
GAP = 10
# Every known sentence has one of these.
_HINTS = (
    "licen", "permission", "redistribut", "warrant", "public domain", "is free software", "all rights reserved", "neither the name", "as is",
    "misrepresented", "altered", "apache", "gpl", "bsd", "mpl", "epl", "eupl", "cc by", "cc-by", "cc0", "creative", "mozilla",
)
_KNOWN = [(kind, re.compile(rf"\b{pattern}\b")) for kind, pattern in SENTENCES]
_LEADS = [(kind, re.compile(rf"(?P<denied>\b{DENIED} )?\b{pattern} ")) for kind, pattern in LEADS]
_NAMES = [(name, re.compile(rf"\b{pattern}"), versions) for name, pattern, versions in NAMES]
_CONDITIONS = [(name, re.compile(rf" {pattern}\b")) for name, pattern in CONDITIONS]
# "version 2", "v2", "2.0", also after "as published by the ... foundation, either".
_VERSION = re.compile(
    rf"(?:{_LIC})?(?: international| universal)?(?: as published by the free software foundation)?(?: either)?"
    r" ?(?:v|ver|version)? ?(?P<number>[0-9]{1,2}(?:\.[0-9]+){0,2})(?![\w.])"
)
_LATER = re.compile(
    rf"(?: of (?:the|that){_LIC})?(?P<later> (?:or|and)(?: at your option)?(?: any| a)? (?:later|newer|higher|subsequent)"
    r"| or as soon(?: \w+){1,12} subsequent versions)|(?P<only> only\b)"
)
_AND_MORE = re.compile(rf"(?:{_LIC})?(?: international)? (?:and or|and|or)(?: under)?(?: the| a)? ")
_SPDX = re.compile(r"(?i:spdx-license-identifier:)[ \t(]*([A-Za-z0-9.+-]+(?:[ \t()]+(?:OR|AND|WITH)[ \t()]+[A-Za-z0-9.+-]+)*)")
_SPDX_AND = re.compile(r"[ \t()]+(?:OR|AND)[ \t()]+")
_SENTENCE_END = re.compile(r"(?<=[.!?])(?<!\b[vV]\.)\s+")
_PLUS = re.compile(r"(?<=[0-9])\+(?!\w)")
_NOT_WORD = re.compile(r"[^\w.]+|\.(?![0-9])|(?<![0-9])\.")
_SPACES = re.compile(r"\s+")
_PARAGRAPH = re.compile(r"\n[^\S\n]*\n")
_COMMENT = re.compile(r"(?m)^[ \t]*(?:/?\*+/?|//+|#+|--|;+|%+)[ \t]?")


def normalised_sentence(sentence: str) -> str:
    """Lower case, signs as one space, dots only inside numbers, + after a number as "or later"."""
    return _SPACES.sub(" ", _NOT_WORD.sub(" ", _PLUS.sub(" or later", sentence.lower()))).strip()


def licence_at(plain: str, at: int) -> tuple[str, int] | None:
    """The licence named at a place of a normalised sentence, with its version, and where the name ends.

    A name in a version that is not known is none; a name without a version
    is the licence without one.
    """
    for name, pattern, versions in _NAMES:
        if not (found := pattern.match(plain, at)):
            continue
        end = found.end()
        if name == "CC-BY":
            asked = set()
            while more := next(((c, m) for c, p in _CONDITIONS if (m := p.match(plain, end))), None):
                asked.add(more[0])
                end = more[1].end()
            name = "-".join([name, *(condition for condition, _ in CONDITIONS if condition in asked)])
        if versions and (version := _VERSION.match(plain, end)):
            number = version["number"] if "." in version["number"] else version["number"] + ".0"
            if number not in versions:
                return None
            name, end = f"{name}-{number}", version.end()
            if later := _LATER.match(plain, end):
                name, end = name + ("-or-later" if later["later"] else "-only"), later.end()
        return name, end
    return None


def known_sentences(sentence: str) -> list[str]:
    """Identifiers of the known sentences within a sentence, in order of their places; denied references are none."""
    lower = sentence.lower()
    if not any(hint in lower for hint in _HINTS):
        return []
    plain = normalised_sentence(sentence)
    found = [(m.start(), kind) for kind, pattern in _KNOWN for m in pattern.finditer(plain)]
    for kind, pattern in _LEADS:
        for lead in pattern.finditer(plain):
            at = lead.end()
            while named := licence_at(plain, at):
                if not lead["denied"]:
                    found.append((at, f"{kind}:{named[0]}"))
                more = _AND_MORE.match(plain, named[1])
                if not more:
                    break
                at = more.end()
    return [name for _, name in sorted(found)]


def placed_sentences(text: str) -> list[tuple[int, str]]:
    """Number of the sentence in the text, and identifier, of every known sentence, in order."""
    lower = text.lower()
    if not any(hint in lower for hint in _HINTS):
        return []
    found, number = [], 0
    for paragraph in _PARAGRAPH.split(_COMMENT.sub("", text)):
        for sentence in _SENTENCE_END.split(paragraph.replace("\n", " ")):
            found += [(number, name) for name in known_sentences(sentence)]
            number += 1
    return found


def sentence_ids(text: str) -> list[str]:
    """Identifiers of the known sentences of a text, in order."""
    return [name for _, name in placed_sentences(text)]


def occurrences(kinds: list[tuple[int, str, int]], rule: tuple[str, ...], gap: int = GAP) -> list[list[int]]:
    """Indices of the sentences of every occurrence of a rule in ``kinds`` (sentence number, kind, index).

    An occurrence ends at the first sentence that ends one, each of its
    sentences is the last possible one before the next, and the next
    occurrence starts after it.  One pass over the sentences.
    """
    step = {kind: k for k, kind in enumerate(rule)}
    found: list[list[int]] = []
    open_: list[list[int]] = [[] for _ in rule]
    last = [0] * len(rule)
    for number, kind, index in kinds:
        k = step.get(kind)
        if k is None or k and not (open_[k - 1] and number - last[k - 1] <= gap):
            continue
        open_[k], last[k] = [*(open_[k - 1] if k else []), index], number
        if k == len(rule) - 1:
            found.append(open_[k])
            open_ = [[] for _ in rule]
    return found


def match_rules(placed: list[tuple[int, str]]) -> list[str]:
    """Licences of the rules that match, in the order of their first sentence."""
    left = [(number, name.partition(":")[0], index) for index, (number, name) in enumerate(placed)]
    found = []
    for licence, rule in RULES:
        matched = occurrences(left, rule)
        used = {index for one in matched for index in one}
        left = [item for item in left if item[2] not in used]
        found += [(one[0], licence or placed[one[0]][1].partition(":")[2]) for one in matched]
    return [licence for _, licence in sorted(found)]


def scan(text: str) -> tuple[list[str], list[str], list[str]]:
    """Sentence identifiers, licences by rule, and identifiers declared by SPDX tags."""
    placed = placed_sentences(text)
    tags = _SPDX.findall(text) if "SPDX" in text or "spdx" in text else []
    declared = sorted({one for tag in tags for one in _SPDX_AND.split(tag)})
    return [name for _, name in placed], sorted(set(match_rules(placed))), declared


def license_scan(docs: DataFrame) -> DataFrame:
    """``doc_id, sentences, licenses, declared, unmatched`` of every row of ``docs(doc_id, text)``.

    ``sentences`` are the known sentences in order, ``licenses`` the different
    licences of matching rules, with the version, ``-only`` and ``-or-later``
    that the text names, ``declared`` those of SPDX tags, and ``unmatched``
    whether known sentences are there but no rule matches.  A reference that
    is denied ("not licensed under") or names an unknown version is no known
    sentence.  A null text is empty and has none; a text costs time and memory
    in proportion to its length.  Repeated rows give repeated rows; other
    columns are ignored; an empty table gives an empty one.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(text) for text in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array([f[k] for f in found], pa.list_(pa.string())) for k in range(3)),
                    pa.array([bool(ids) and not licences for ids, licences, _ in found], pa.bool_()),
                ],
                ["doc_id", "sentences", "licenses", "declared", "unmatched"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    lists = "sentences array<string>, licenses array<string>, declared array<string>"
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {id_type}, {lists}, unmatched boolean")
