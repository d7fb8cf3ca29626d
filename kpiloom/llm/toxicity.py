"""Toxicity by a noisy channel: disguised words are restored, then the text is scored.

A character language model holds trigram costs, counted over all texts.  A
word that looks disguised (signs or digits among letters, letters repeated,
separators inside, letters spaced out) becomes a lattice: each character offers the letters it
may stand for, repeated letters and separators may also stand for nothing.
The Viterbi path is the cheapest reading under the language model.

Words, read plainly and restored, give features: the word and its beginnings.
Features that set toxic texts apart are weighted by logistic regression with a
penalty on absolute weights, on a bounded sample of labelled rows.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import texts

# Labelled rows the classifier is fitted on, of each label those with the smallest hashes of their id.
SAMPLE_TOXIC, SAMPLE_CLEAN = 4000, 8000
FEATURES = 4000
BEGINNINGS = (4, 5, 6)
LEAST_TEXTS, LEAST_SHARE, LEAST_ODDS = 3, 0.002, 20.0
PENALTY, STEPS = 0.0005, 400
# Tokens remembered by a generation, and the longest that are.
REMEMBERED, REMEMBERED_LENGTH = 100_000, 64

# The letters of the language model, and what signs may stand for.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœ"
DISGUISES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y", "§": "s",
    "*": "aeiou", "#": "aeiou", "%": "aeiou", "&": "aeiou",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ј": "j",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "ν": "v", "τ": "t", "κ": "k",
}
SEPARATORS = " .-_,'~"

_SIZE = len(LETTERS) + 1
_INDEX = {letter: k + 1 for k, letter in enumerate(LETTERS)}
_CODE = np.zeros(0x250, np.int64)
for _letter, _k in _INDEX.items():
    _CODE[ord(_letter)] = _k
_ANY_SIGN = re.escape("".join(DISGUISES))
_SIGN = re.compile(f"[{_ANY_SIGN}]")
_DOUBLED = re.compile(r"([^\W\d_])\1")
_SAME = re.compile(r"(.)\1+")
_INNER = re.compile(rf"[\w{_ANY_SIGN}][{re.escape(SEPARATORS)}]+[\w{_ANY_SIGN}]")
_LETTER = re.compile(r"[^\W\d_]")
# Signs only, two different ones: '@$$'.
_SIGNS_ONLY = re.compile(rf"(?!(.)\1*$)(?:(?!\d)[{_ANY_SIGN}]){{2,}}")
_PUNCTUATED = re.compile(r"\w(?:[.\-_~*']\w){2,}")
_OPENING, _CLOSING = "([{\"'“«¿¡", ".,;:!?)]}\"'”»…"
# Single characters with separators between them: at most three spaces in a row, any number of the other ones.
# A character is one or the other and nothing is given back, so the time of a search grows with the text.
_BETWEEN = r"(?: {1,3}+(?:[.\-_]++ {0,3}+)*+|(?:[.\-_]++ {0,3}+)++)"
_SPACED = re.compile(rf"(?<!\S)[^\s.\-_](?:{_BETWEEN}[^\s.\-_]){{2,}}+")
_SINGLE = re.compile(r"[^\s.\-_]")
_BEFORE_SPACE = re.compile(r"[^\s.\-_](?=\s)")
_WORD = re.compile(r"[^\W\d_]+")
_COSTS = {"same": 0.0, "disguise": 0.4, "sign": 1.0, "repeat": 0.2, "separator": 0.1, "gap": 1.0}


def trigram_counts(docs: DataFrame) -> DataFrame:
    """``code, n``: how often three characters follow each other in all texts of ``docs(text)``.

    Characters other than the model's letters count as a space, runs of them
    as one.  Each task sends one row per different trigram.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SIZE**3, np.int64)
        for batch in batches:
            for text in texts(batch.column(0)):
                points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
                code = np.where(points < len(_CODE), _CODE[np.minimum(points, len(_CODE) - 1)], 0)
                code = np.concatenate(([0, 0], code, [0]))
                keep = np.ones(len(code), bool)
                keep[2:] = (code[2:] > 0) | (code[1:-1] > 0)
                code = code[keep]
                three = (code[:-2] * _SIZE + code[1:-1]) * _SIZE + code[2:]
                if len(three) > len(total):
                    total += np.bincount(three, minlength=len(total))
                else:
                    np.add.at(total, three, 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["code", "n"])

    counted = docs.select("text").mapInArrow(count, "code long, n long")
    return counted.groupBy("code").agg(F.sum("n").alias("n"))


def language_costs(codes: np.ndarray, counts: np.ndarray) -> list[float]:
    """Negative log probabilities of the third character of a trigram, mixed with those of shorter contexts."""
    three = np.zeros(_SIZE**3)
    three[codes] = counts
    three = three.reshape(_SIZE, _SIZE, _SIZE)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p_one = (one + 1) / (one.sum() + _SIZE)
    p_two = two / np.maximum(two.sum(axis=1, keepdims=True), 1)
    p_three = three / np.maximum(three.sum(axis=2, keepdims=True), 1)
    return (-np.log(0.7 * p_three + 0.2 * p_two[None] + 0.1 * p_one)).ravel().tolist()


def _readings(sign: str, repeated: bool) -> list[tuple[str, float]]:
    """What a character may stand for, with the channel's costs; the empty string is nothing."""
    if sign in _INDEX:
        found = [(sign, _COSTS["same"])]
        return [*found, ("", _COSTS["repeat"])] if repeated else found
    if sign in SEPARATORS:
        return [(" ", 0.0)] if repeated else [("", _COSTS["separator"]), (" ", _COSTS["gap"])]
    if sign in DISGUISES:
        found = [(letter, _COSTS["disguise"]) for letter in DISGUISES[sign]]
        return [*found, ("", _COSTS["sign"])] if repeated else found
    return [(" ", 0.0)]


def _letters(node: tuple | None) -> str:
    found = []
    while node:
        node, letter = node
        found.append(letter)
    return "".join(reversed(found))


def restored(observed: str, costs: list[float]) -> str:
    """The cheapest reading of a whole disguised run, in lower case.

    A state is the last two letters, a path its cost and a chain of letters
    back to where all paths agreed last; no state is left out.  Time and
    memory grow with the length of the run.
    """
    agreed, before = [], ""
    paths: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for sign in observed:
        repeated, before = sign == before, sign
        if len(paths) == 1 and sign in _INDEX and not repeated:
            agreed.append(sign)
            paths = {next(iter(paths)) % _SIZE * _SIZE + _INDEX[sign]: (0.0, None)}
            continue
        after: dict[int, tuple[float, tuple | None]] = {}
        for letter, channel in _readings(sign, repeated):
            code = _INDEX.get(letter, 0)
            for state, (cost, node) in paths.items():
                if letter and (code or state % _SIZE):
                    total, node = cost + channel + costs[state * _SIZE + code], (node, letter)
                    state = state % _SIZE * _SIZE + code
                else:
                    total = cost + channel
                if state not in after or total < after[state][0]:
                    after[state] = total, node
        if len(after) == 1:
            ((state, (_, node)),) = after.items()
            agreed.append(_letters(node))
            after = {state: (0.0, None)}
        paths = after
    ends = ((cost + (costs[state * _SIZE] if state % _SIZE else 0.0), node) for state, (cost, node) in paths.items())
    return "".join(agreed) + _letters(min(ends, key=lambda end: end[0])[1])


def _of_words(words: list[str]) -> set[str]:
    found = set()
    for word in words:
        found.add(word + " ")
        found.update(word[:k] for k in BEGINNINGS if len(word) > k)
    return found


def _cores(token: str) -> set[str]:
    """What may be the disguised word of a token.

    Signs around a word are punctuation or stand for letters, so runs of them
    are left out, or only usual punctuation, or only signs that never stand
    for a letter.
    """
    n, first, last = len(token), 0, 0
    while first < n and not (token[first].isalnum() or token[first] == "_"):
        first += 1
    while last < n - first and not (token[n - 1 - last].isalnum() or token[n - 1 - last] == "_"):
        last += 1
    cores = {token}
    if first or last:
        a = first if first > 1 or token[0] in _OPENING else 0
        b = last if last > 1 or token[-1] in _CLOSING else 0
        c = next((k for k in range(first) if token[k] in DISGUISES), first)
        d = next((k for k in range(last) if token[n - 1 - k] in DISGUISES), last)
        cores = {token[a : n - b], token.lstrip(_OPENING).rstrip(_CLOSING), token[c : n - d]}
    return {
        core
        for core in cores
        if (_LETTER.search(core) and (_SIGN.search(core) or _DOUBLED.search(core) or _INNER.search(core)))
        or _PUNCTUATED.fullmatch(core)
        or _SIGNS_ONLY.fullmatch(core)
    }


def _of_token(token: str, costs: list[float]) -> set[str]:
    """Features of one white-space token in lower case, read plainly and restored."""
    found = _of_words(_WORD.findall(token))
    for core in _cores(token):
        found |= _of_words(_WORD.findall(restored(core, costs)))
    return found


def spaced_runs(text: str) -> Iterator[str]:
    """Spaced out letters: three or more single characters with separators between them, white space around.

    Where a chain goes on into a longer word, the run ends with its last
    character that white space follows.
    """
    for match in _SPACED.finditer(text):
        run, end = match.group(), match.end()
        if end < len(text) and not text[end].isspace():
            run = run[: max((last.end() for last in _BEFORE_SPACE.finditer(run)), default=0)]
            if len(_SINGLE.findall(run)) < 3:
                continue
        yield run


def _spaced_out(text: str, costs: list[float]) -> Iterator[str]:
    for run in spaced_runs(text):
        yield from _of_words(_WORD.findall(restored(run, costs)))


def features_of(text: str, costs: list[float], known: dict[str, set[str]] | None = None) -> set[str]:
    """All features of a text: words with a space behind them, and beginnings of longer words.

    ``known`` remembers a bounded number of tokens from text to text.
    """
    lower = text.lower()
    found = set()
    known = {} if known is None else known
    for token in set(lower.split()):
        of = known.get(token)
        if of is None:
            of = _of_token(token, costs)
            if len(known) >= REMEMBERED // 4:
                known.clear()
            if len(token) <= REMEMBERED_LENGTH:
                known[token] = of
        found |= of
    found.update(_spaced_out(lower, costs))
    return found


def _alike() -> dict[int, str]:
    """Of each letter and sign the first letter that a chain of shared readings leads to; separators become nothing."""
    parent: dict[str, str] = {}

    def top(sign: str) -> str:
        while parent.setdefault(sign, sign) != sign:
            sign = parent[sign]
        return sign

    for sign, letters in DISGUISES.items():
        for letter in letters:
            one, other = sorted((top(sign), top(letter)), key=lambda s: (s not in _INDEX, s))
            parent[other] = one
    return {**{ord(sign): top(sign) for sign in list(parent)}, **{ord(sign): "" for sign in SEPARATORS}}


_ALIKE = _alike()


def outline(word: str) -> str:
    """What all readings of a word have in common: signs and letters that stand for each other are one, repeats and separators none.

    The outline of every word of a reading occurs in the outline of what is read.
    """
    return _SAME.sub(r"\1", word.translate(_ALIKE))


@dataclass
class ToxicityModel:
    """``costs`` of the language model, feature ``weights`` and ``bias``."""

    costs: list[float]
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


class Scorer:
    """Finds the features of texts that have a weight, remembering a bounded number of tokens.

    A token is decoded only if its outline holds that of a feature; no other
    can be read as one.
    """

    def __init__(self, model: ToxicityModel):
        self.model = model
        # Two generations of tokens: the older one is dropped when the younger one is full.
        self.known: dict[str, tuple[str, ...]] = {}
        self.older: dict[str, tuple[str, ...]] = {}
        self.starts = {f.rstrip()[: BEGINNINGS[0]] for f in model.weights}
        outlines = sorted({outline(f.rstrip()) for f in model.weights}, key=lambda o: (len(o), o))
        self.outlines: list[str] = []
        for found in outlines:  # one that holds another is found with it
            if not any(shorter in found for shorter in self.outlines):
                self.outlines.append(found)

    def of_token(self, token: str) -> tuple[str, ...]:
        found = self.older.get(token)
        if found is None:
            core = token.rstrip(".,")
            if core.isalpha() and core[: BEGINNINGS[0]] not in self.starts and not (_DOUBLED.search(core) or _SIGN.search(core)):
                found = ()
            else:
                shape = outline(token)
                if any(one in shape for one in self.outlines):
                    found = tuple(f for f in _of_token(token, self.model.costs) if f in self.model.weights)
                else:
                    found = ()
        if len(self.known) >= REMEMBERED:
            self.older, self.known = self.known, {}
        if len(token) <= REMEMBERED_LENGTH:
            self.known[token] = found
        return found

    def features(self, text: str) -> set[str]:
        lower = text.lower()
        known, weights = self.known, self.model.weights
        found: set[str] = set()
        for token in set(lower.split()):
            of = known.get(token)
            if of is None:
                of = self.of_token(token)
                known = self.known
            if of:
                found.update(of)
        found.update(f for f in _spaced_out(lower, self.model.costs) if f in weights)
        return found

    def score(self, text: str) -> float:
        total = self.model.bias + math.fsum(self.model.weights[f] for f in self.features(text))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


_scorers: dict[str, Scorer] = {}


def _scorer(model: ToxicityModel) -> Scorer:
    """The worker's scorer of this model; what it remembers serves later tasks."""
    if model.name not in _scorers:
        _scorers.clear()
        _scorers[model.name] = Scorer(model)
    return _scorers[model.name]


def fit_weights(rows: list[list[int]], toxic: np.ndarray, n_features: int) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of features by proximal gradient steps with momentum."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    flat = np.array([f for r in rows for f in r], np.int64)
    weights, bias = np.zeros(n_features), 0.0
    share = np.where(toxic > 0, 0.5 / max(1, toxic.sum()), 0.5 / max(1, len(toxic) - toxic.sum()))
    ahead, ahead_bias, momentum = weights.copy(), bias, 1.0
    rate = 2.0
    for _ in range(STEPS):
        z = np.bincount(owner, ahead[flat], len(rows)) + ahead_bias
        error = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic)
        gradient = np.bincount(flat, error[owner], n_features)
        stepped = ahead - rate * gradient
        new = np.sign(stepped) * np.maximum(np.abs(stepped) - rate * PENALTY, 0)
        new_bias = ahead_bias - rate * error.sum()
        grown = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / grown * (new - weights)
        ahead_bias = new_bias + (momentum - 1) / grown * (new_bias - bias)
        weights, bias, momentum = new, new_bias, grown
    return weights, bias


def fit(docs: DataFrame, labels: DataFrame, usable: Column) -> ToxicityModel:
    """Language model from all texts, weights from a sample of ``labels(doc_id, toxic)`` whose ids are ``usable``.

    Without labels of both kinds no feature has a weight and all scores are low.
    The sample is bounded by `SAMPLE_TOXIC` and `SAMPLE_CLEAN`, the model by
    `FEATURES`, the features in the most toxic texts.
    """
    spark = docs.sparkSession
    counts = trigram_counts(docs).toArrow()
    costs = language_costs(counts["code"].to_numpy(), counts["n"].to_numpy())
    held = spark.sparkContext.broadcast(costs)
    known = labels.where(usable & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.col("doc_id").cast("string")).alias("at")
    known = known.select("doc_id", F.col("toxic").cast("int").alias("toxic"), order)
    kinds = [known.where(f"toxic = {k}").orderBy("at", "doc_id").limit(n) for k, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))]
    chosen = F.broadcast(kinds[0].unionAll(kinds[1]))
    sample = docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "toxic").distinct()

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[Counter] = [Counter(), Counter()]
        seen, known = [0, 0], {}
        for batch in batches:
            for text, toxic in zip(texts(batch.column(0)), batch.column(1).to_pylist()):
                total[toxic].update(features_of(text, held.value, known))
                seen[toxic] += 1
        for toxic in (0, 1):
            total[toxic][""] = seen[toxic]
        names = sorted(total[0].keys() | total[1].keys())
        counts = [pa.array([total[k][name] for name in names], pa.int64()) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *counts], ["feature", "clean", "toxic"])

    per_task = sample.mapInArrow(features, "feature string, clean long, toxic long")
    all_counts = per_task.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # The row "" counts the texts; it comes first, whatever the others are.
    telling = all_counts.where((F.col("feature") == "") | (F.col("toxic") >= LEAST_TEXTS)).orderBy(
        (F.col("feature") == "").desc(),
        ((F.col("toxic") + 0.0) / (F.col("clean") + 1.0) * F.col("toxic")).desc(),
        "feature",
    )
    rows = {r["feature"]: (r["clean"], r["toxic"]) for r in telling.limit(20 * FEATURES).collect()}
    clean, toxic = rows.pop("", (0, 0))
    least = max(LEAST_TEXTS, LEAST_SHARE * toxic)
    good = [f for f, (c, t) in rows.items() if t >= least and t / max(1, toxic) > LEAST_ODDS * (c + 0.5) / max(1, clean)]
    good = sorted(good, key=lambda f: (-rows[f][1], f))[:FEATURES]
    if not good or not clean:
        return ToxicityModel(costs)
    number = {f: k for k, f in enumerate(good)}
    chosen_features = spark.sparkContext.broadcast(ToxicityModel(costs, dict.fromkeys(good, 1.0)))

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(chosen_features.value)
        for batch in batches:
            found = [sorted(number[f] for f in scorer.features(text)) for text in texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["toxic", "found"])

    bags = sample.mapInArrow(present, "toxic int, found array<int>").collect()
    bags = sorted((list(r["found"]), r["toxic"]) for r in bags)
    weights, bias = fit_weights([b for b, _ in bags], np.array([t for _, t in bags], float), len(good))
    return ToxicityModel(costs, {f: float(weights[k]) for f, k in number.items() if weights[k]}, float(bias))


def scored(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score, predicted`` of every row of ``docs(doc_id, text)``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(held.value)
        for batch in batches:
            scores = [scorer.score(text) for text in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                ["doc_id", "score", "predicted"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int"
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def without_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns kept; decided where the row is, without a shuffle.

    Each row is decided by its text alone: repeated rows and rows without an id
    stay or go by it, null and empty texts stay, an empty table stays empty.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(held.value)
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t) < 0.5 for t in texts(batch.column(text))], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """Fits a model and scores every row of ``docs(doc_id, text)``.

    Null and empty texts get the score of a text without features, which is
    low.  Repeated rows give repeated rows; several labels of one id count as
    toxic if any is; other columns are ignored; an empty table gives an empty
    one.
    """
    return scored(docs, fit(docs, labels, usable))
