"""Language identification by averaged hashed subword embeddings.

A text is its subwords: runs of 2 to 4 bytes inside a word, with a mark for
each end of the word, hashed to rows of an embedding table.  The average of
the rows goes through a linear softmax.  Table and softmax are trained by
stochastic gradient descent in numpy on a bounded sample of labelled rows;
then the softmax is calibrated on rows the training did not use, and a
confidence is chosen below which a prediction counts as rejected.

Because the softmax is linear, a subword's share in the result is one row of
``table @ weights``; whole texts of any length are scored by adding rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import texts

SUBWORDS = (2, 3, 4)
BUCKETS = 1 << 15
WIDTH = 16
# Labelled rows the model is fitted on, those with the smallest hashes of their id.
SAMPLE_ROWS = 6000
EPOCHS = 6
RATE = 2.0
# Share of right calibration rows that may be rejected.
REJECT_RIGHT = 0.01
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MARKS = [b"\xc2\xa0", b"\xe3\x80\x80", b"\xef\xbb\xbf"]


def has_letter(text: str) -> bool:
    """Whether any character is a letter in Unicode's sense."""
    return any(map(str.isalpha, text)) if text else False


def subwords(text: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """The buckets of all subwords of a text's bytes; each run of other characters is one mark."""
    letter = _LETTER[text]
    keep = letter.copy()
    keep[:-1] |= letter[1:] if len(letter) > 1 else False
    code = np.where(letter, _LOWER[text], np.uint8(32))[keep]
    code = np.concatenate((np.array([32], np.uint8), code, np.array([32], np.uint8))).astype(np.uint32)
    mark = code == 32
    found = []
    for size in SUBWORDS:
        n = len(code) - size + 1
        if n < 1:
            break
        value = np.full(n, np.uint32(size), np.uint32)
        crossing = np.zeros(n, bool)
        for k in range(size):
            value = value * np.uint32(0x01000193) ^ code[k : k + n]
            if 0 < k < size - 1:
                crossing |= mark[k : k + n]
        if size == 2:
            crossing = mark[:n] & mark[1 : 1 + n]
        value = (value ^ (value >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        found.append((value ^ (value >> np.uint32(13)))[~crossing] & np.uint32(buckets - 1))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def bag(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The different buckets of a text and their shares."""
    found = subwords(np.frombuffer(text.encode(), np.uint8), buckets)
    ids, counts = np.unique(found, return_counts=True)
    return ids.astype(np.int64), (counts / max(1, len(found))).astype(np.float32)


@dataclass
class LanguageModel:
    """``table`` of subword embeddings, softmax ``weights`` and ``bias``, calibration."""

    languages: list[str]
    table: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, ids: np.ndarray, shares: np.ndarray) -> np.ndarray:
        return (shares @ self.table[ids]) @ self.weights + self.bias


def _softmax(logits: np.ndarray) -> np.ndarray:
    grown = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return grown / grown.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, str]], seed: int = 7) -> LanguageModel | None:
    """Fits a model to bags with their languages; every fifth row calibrates it.

    Without rows there is no model.
    """
    if not rows:
        return None
    languages = sorted({language for *_, language in rows})
    number = {language: k for k, language in enumerate(languages)}
    rng = np.random.default_rng(seed)
    model = LanguageModel(
        languages,
        rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32),
        np.zeros((WIDTH, len(languages)), np.float32),
        np.zeros(len(languages), np.float32),
    )
    held = rows[::5] if len(rows) >= 50 else rows
    fitted = [row for k, row in enumerate(rows) if k % 5] if len(rows) >= 50 else rows
    total = EPOCHS * len(fitted)
    for step, i in enumerate(np.concatenate([rng.permutation(len(fitted)) for _ in range(EPOCHS)])):
        ids, shares, language = fitted[i]
        rate = np.float32(RATE * (1 - step / total))
        hidden = shares @ model.table[ids]
        error = _softmax(hidden @ model.weights + model.bias)
        error[number[language]] -= 1
        back = model.weights @ error
        model.weights -= rate * np.outer(hidden, error)
        model.bias -= np.float32(0.1) * rate * error
        model.table[ids] -= rate * np.outer(shares, back) * np.float32(20)
    return _calibrated(model, held, number)


def _calibrated(model: LanguageModel, held: list, number: dict[str, int]) -> LanguageModel:
    """The temperature of the smallest loss, and the confidence that few right rows fall below."""
    logits = np.array([model.logits(ids, shares) for ids, shares, _ in held], np.float64)
    right = np.array([number[language] for *_, language in held])
    row = np.arange(len(held))

    def loss(temperature: float) -> float:
        return -np.log(np.maximum(_softmax(logits / temperature)[row, right], 1e-12)).mean()

    model.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    sure = _softmax(logits / model.temperature)
    good = sure.max(axis=1)[sure.argmax(axis=1) == right]
    model.threshold = float(np.quantile(good, REJECT_RIGHT)) if len(good) else 0.0
    return model


def fit(docs: DataFrame, usable: Column, sample_rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """A model from at most ``sample_rows`` rows of ``docs(doc_id, text, lang)`` that are ``usable``.

    The rows are those with the smallest hashes of their id, so the choice
    does not depend on how the table is stored.  Tasks turn texts into bags;
    only those reach the driver.
    """
    some = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = some.select("doc_id", order.alias("at")).orderBy("at", "doc_id").limit(sample_rows)
    chosen = F.broadcast(chosen.select("doc_id", "at").distinct())

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bag(text) for text in texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([ids.astype(np.int32) for ids, _ in found], pa.list_(pa.int32())),
                    pa.array([shares for _, shares in found], pa.list_(pa.float32())),
                ],
                ["at", "lang", "ids", "shares"],
            )

    sample = some.select("doc_id", "lang", "text").join(chosen, "doc_id").select("at", "lang", "text")
    rows = sample.mapInArrow(bags, "at long, lang string, ids array<int>, shares array<float>").toArrow()
    rows = rows.sort_by([("at", "ascending"), ("lang", "ascending")])
    return train(
        [
            (ids.values.to_numpy().astype(np.int64), shares.values.to_numpy(), lang.as_py())
            for ids, shares, lang in zip(rows["ids"], rows["shares"], rows["lang"])
            if len(ids)
        ]
    )


def identified(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every row of ``docs(doc_id, text)``.

    ``score`` is the calibrated probability of the prediction, ``rejected``
    whether it is below the model's threshold.  A null text, or one without a
    letter, is ``und`` with score 0 and rejected, as is every text without a
    model.  A text whose letters give no subword gets the likeliest language.
    """
    shares = None if model is None else (model.table @ model.weights).astype(np.float32)
    held = docs.sparkSession.sparkContext.broadcast((model, shares))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, share = held.value
        for batch in batches:
            names, scores, rejected = [], [], []
            for text in texts(batch.column(1)):
                if model is None or not has_letter(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                found = subwords(np.frombuffer(text.encode(), np.uint8))
                counts = np.bincount(found, minlength=BUCKETS).astype(np.float32)
                logits = (counts @ share) / max(1, len(found)) + model.bias
                sure = _softmax(logits.astype(np.float64) / model.temperature)
                names.append(model.languages[int(sure.argmax())])
                scores.append(float(sure.max()))
                rejected.append(bool(sure.max() < model.threshold))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean"
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def language_id(docs: DataFrame, held_out: Column, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Fits a model to the rows that are not ``held_out`` and predicts all rows of ``docs(doc_id, text, lang)``."""
    return identified(docs, fit(docs, ~held_out, sample_rows))
