"""Personal data, found also where it is disguised.

Identifiers are found in the text as it stands.  Then transducers rewrite the
disguises: look-alike characters, at and dot written out or in brackets, and
digits written as words.  Each keeps, for every character that it writes,
which characters of the source it stands for.  Identifiers of the rewritten
text are mapped back to the source and added where none was found before.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from kpiloom.llm.common import texts

KINDS = ("email", "ip", "card", "phone")

# Characters that look like a Latin letter or digit, and words for signs and digits.
LOOK_ALIKES = str.maketrans(
    "АВЕКМНОРСТХаеорсухіѕјԁһΑΒΕΖΗΙΚΜΝΟΡΤΥΧοѵɡ․。＠﹫∂",
    "ABEKMHOPCTXaeopcyxisjdhABEZHIKMNOPTYXovg..@@d",
)
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
    "ocho": "8", "nueve": "9",
}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_IP_HINT = re.compile(r"[0-9]\.[0-9]")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")

_DOT_WORDS = "dot|punkt|point|punto"
# White space before a bracket goes with it, see `Rewriting.replace`.
_BRACKET_AT = re.compile(r"[\[({<]\s*(?:at|@)\s*[\])}>]\s*", re.I)
_BRACKET_DOT = re.compile(r"[\[({<]\s*(?:" + _DOT_WORDS + r"|\.)\s*[\])}>]\s*", re.I)
# 'at this point in time' is no address: behind 'point' comes a top-level domain that is no common word.
_COMMON = "am|an|as|at|be|by|do|go|he|if|in|is|it|me|my|no|of|on|or|so|to|up|us|we"
_DOTTED = rf"(?:\s+(?:dot|punkt|punto)\s+|\s+point\s+(?=(?:[a-z0-9-]+\s+point\s+)*(?:com|org|net|info|edu|gov|biz|(?!(?:{_COMMON})\b)[a-z]{{2}})(?![\w-]))|\s*\.)"
_PLAIN_AT = re.compile(rf"(?<=[A-Za-z0-9_%+-])\s+at\s+(?=(?:[A-Za-z0-9-]+{_DOTTED})+[A-Za-z][A-Za-z0-9-])", re.I)
_PLAIN_DOT = re.compile(rf"(?<=[A-Za-z0-9])\s+(?:{_DOT_WORDS})\s+(?=[A-Za-z0-9])", re.I)
_WORDS = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_DIGIT_RUN = re.compile(rf"(?<!\w)(?:plus[ -]+)?(?:(?:{_WORDS}|[0-9]+)[ .,-]{{1,2}}){{3,}}(?:{_WORDS}|[0-9]+)(?!\w)", re.I)
_DIGIT_WORD = re.compile(rf"(?<!\w)(?:plus|{_WORDS})(?!\w)", re.I)
_DIGIT_HINT = re.compile(
    rf"(?<!\w)(?:{_WORDS})[ .,-]{{1,2}}(?:{_WORDS}|[0-9])|[0-9][ .,-]{{1,2}}(?:{_WORDS})(?!\w)", re.I
)
_SPELLED = re.compile(rf"(?<!\w)(?:{_WORDS})(?:[ ,-]{{1,2}}(?:{_WORDS}))*(?!\w)", re.I)
_INVISIBLE = re.compile("[­​-‏⁠﻿]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The longest local part left of each ``@`` that a domain follows."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    return


def _luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _ip_fits(found: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in found.split("."))


def _card_fits(found: str) -> bool:
    digits = "".join(_DIGITS.findall(found))
    return 14 <= len(digits) <= 19 and _luhn(digits)


def _phone_fits(found: str) -> bool:
    return 10 <= sum(map(len, _DIGITS.findall(found))) <= 15


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """``start, kind number, end`` of the identifiers in a text as it stands, in order."""
    found = []
    if "@" in text:
        found += [(start, 0, end) for start, end in emails(text)]
    if _DIGITS.search(text):
        checks = ((1, _IP, _ip_fits), (2, _CARD, _card_fits), (3, _PHONE, _phone_fits))
        for kind, pattern, fits in checks:
            if kind == 1 and not _IP_HINT.search(text) or kind == 3 and "+" not in text:
                continue
            found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if fits(m.group())]
    return sorted(found)


class Rewriting:
    """A text with the source range of each character.

    Kept are segments only: where one begins, where that is in the source, and,
    if it was written for a match, where the match ends there; the characters
    of the other segments are those of the source, one by one.
    """

    def __init__(self, text: str):
        self.text = text
        self.at, self.starts, self.ends = [0], [0], [-1]

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source range of a range of the text."""
        first, last = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        a = self.starts[first] + (start - self.at[first] if self.ends[first] < 0 else 0)
        return a, self.ends[last] if self.ends[last] >= 0 else self.starts[last] + end - self.at[last]

    def replace(self, pattern: re.Pattern, write: Callable[[re.Match], str], *, space_before: bool = False) -> None:
        """Rewrites all matches, with the white space before them if asked to; what is written stands for its whole match."""
        parts, at, starts, ends = [], [], [], []
        done = length = 0

        def copy(stop: int) -> None:
            nonlocal done, length
            k = bisect_right(self.at, done) - 1
            while done < stop:
                until = min(stop, self.at[k + 1]) if k + 1 < len(self.at) else stop
                at.append(length)
                starts.append(self.starts[k] + (done - self.at[k] if self.ends[k] < 0 else 0))
                ends.append(self.ends[k])
                length += until - done
                done, k = until, k + 1

        for match in pattern.finditer(self.text):
            a, b = match.span()
            while space_before and a > done and self.text[a - 1].isspace():
                a -= 1
            parts.append(self.text[done:a])
            copy(a)
            new = write(match)
            if new:
                start, end = self.source(a, b)
                at.append(length)
                starts.append(start)
                ends.append(end)
                length += len(new)
            parts.append(new)
            done = b
        if parts:
            parts.append(self.text[done:])
            copy(len(self.text))
            self.text, self.at, self.starts, self.ends = "".join(parts), at or [0], starts or [0], ends or [-1]

    def translate(self, signs: dict[int, str]) -> None:
        """Rewrites single characters by single ones, which stay where they are."""
        self.text = self.text.translate(signs)


def _look_alike(sign: str) -> str:
    plain = sign.translate(LOOK_ALIKES)
    if plain == sign:
        folded = unicodedata.normalize("NFKC", sign)
        plain = folded if len(folded) == 1 and folded.isascii() and (folded.isalnum() or folded in "@.+-_() ") else sign
        if sign.isdecimal():
            plain = str(unicodedata.decimal(sign))
    return plain


def _has_look_alikes(text: str) -> bool:
    return not text.isascii() and any(_look_alike(sign) != sign for sign in set(text) if sign > "\x7f")


def _spelled_digits(run: Rewriting) -> None:
    """Digit words of a run become digits; the gaps between them go."""
    inner = re.compile(rf"(plus|{_WORDS})|([ .,-]{{1,2}})(?=plus|{_WORDS}|[0-9])", re.I)

    def write(match: re.Match) -> str:
        out = inner.sub(lambda m: DIGIT_WORDS.get(m[1].lower(), "+") if m[1] else "", match.group())
        return out

    parts = list(_DIGIT_RUN.finditer(run.text))
    if any(_DIGIT_WORD.search(match.group()) for match in parts):
        run.replace(_DIGIT_RUN, lambda m: write(m) if _DIGIT_WORD.search(m.group()) else m.group())


def _spelled_parts(run: Rewriting) -> Rewriting | None:
    """The text with neighbouring digit words as numbers and the dots between numbers kept, if a run has both."""
    parts = (match.group() for match in _DIGIT_RUN.finditer(run.text))
    if not any("." in part and _SPELLED.search(part) for part in parts):
        return None
    kept = Rewriting(run.text)
    kept.at, kept.starts, kept.ends = run.at, run.starts, run.ends
    digit = re.compile(_WORDS, re.I)
    kept.replace(_SPELLED, lambda m: "".join(DIGIT_WORDS[word.lower()] for word in digit.findall(m.group())))
    return kept


def normalised(text: str) -> list[tuple[Rewriting, range]]:
    """The text with its disguises rewritten, and the numbers of the kinds to find there; nothing if it has none.

    A second rewriting keeps the dots between spelled numbers, for IP addresses.
    """
    look = _has_look_alikes(text)
    bracket = any(sign in text for sign in "[({<") and (_BRACKET_AT.search(text) or _BRACKET_DOT.search(text))
    plain = _PLAIN_AT.search(text) or _PLAIN_DOT.search(text)
    digits = _DIGIT_HINT.search(text)
    hidden = not text.isascii() and _INVISIBLE.search(text)
    if not (look or bracket or plain or digits or hidden):
        return []
    run = Rewriting(text)
    if hidden:
        run.replace(_INVISIBLE, lambda m: "")
    if look:
        run.translate({ord(sign): _look_alike(sign) for sign in set(run.text) if sign > "\x7f"})
    run.replace(_BRACKET_AT, lambda m: "@", space_before=True)
    run.replace(_BRACKET_DOT, lambda m: ".", space_before=True)
    run.replace(_PLAIN_AT, lambda m: "@")
    run.replace(_PLAIN_DOT, lambda m: ".")
    parts = _spelled_parts(run)
    _spelled_digits(run)
    found = ((run, range(len(KINDS))), (parts, range(1, 2)))
    return [(rewritten, kinds) for rewritten, kinds in found if rewritten and rewritten.text != text]


def find_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans with those that only the rewritten text shows."""
    base = identifiers(text)
    # Per kind the spans in order, none over another, so that only neighbours can be in the way.
    taken: list[list[tuple[int, int]]] = [[(start, end) for start, k, end in base if k == kind] for kind in range(len(KINDS))]
    for run, kinds in normalised(text):
        for start, kind, end in identifiers(run.text):
            if kind not in kinds:
                continue
            a, b = run.source(start, end)
            spans = taken[kind]
            k = bisect_left(spans, (a, a))
            if not (k and a < spans[k - 1][1]) and not (k < len(spans) and spans[k][0] < b):
                spans.insert(k, (a, b))
    return base, sorted((start, kind, end) for kind, spans in enumerate(taken) for start, end in spans)


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    """Spans as ``kind:start:end``, by start and then kind, joined by commas."""
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_email_all …`` of every row of ``docs(doc_id, text)``.

    Counts and digest are of the identifiers in the text as it stands;
    ``spans`` also has those found behind disguises, and ``n_*_all`` counts them.  Offsets are code points,
    ends exclusive.  A null text is empty: no spans, and the digest of the
    empty string.  A very long text costs its own size a few times and an entry
    per disguise.  Out of scope are at and dot in other languages than those of
    the patterns, and letters or the digits of an IP address spaced out singly.
    Repeated rows give repeated rows; other columns are
    ignored; an empty table gives an empty one.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_spans(text) for text in texts(batch.column(1))]
            counts = [[sum(span[1] == kind for span in base) for base, _ in found] for kind in range(len(KINDS))]
            digests = [hashlib.sha256(spans_text(base).encode()).hexdigest() for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array(digests, pa.string()),
                    pa.array([spans_text(spans) for _, spans in found], pa.string()),
                    *(pa.array([sum(span[1] == kind for span in spans) for _, spans in found], pa.int64()) for kind in range(len(KINDS))),
                ],
                ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", *(f"n_{kind}_all" for kind in KINDS)],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    every = ", ".join(f"n_{kind}_all long" for kind in KINDS)
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {id_type}, {counts}, base_sha256 string, spans string, {every}")
