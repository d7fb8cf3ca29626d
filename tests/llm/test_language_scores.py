"""Language scores against a plain-Python reading of the model, and odd tables."""

import math
import random

import numpy as np
import pytest

from kpiloom.llm import language_id
from kpiloom.llm.common import prepared


def plain_subwords(text):
    """Buckets of a text, one byte at a time: words of letters, their ends marked, all runs of 2 to 4 inside a word."""
    cleaned, run = [], False
    for byte in text.encode():
        lower = byte + 32 if 65 <= byte <= 90 else byte
        if 97 <= lower <= 122 or lower >= 128:
            cleaned.append(lower)
            run = False
        elif not run:
            cleaned.append(32)
            run = True
    padded = [32, *cleaned, 32]
    found = []
    for size in (2, 3, 4):
        for at in range(len(padded) - size + 1):
            part = padded[at : at + size]
            if 32 in part[1:-1] or part == [32, 32]:
                continue
            value = size
            for byte in part:
                value = (value * 0x01000193 & 0xFFFFFFFF) ^ byte
            value = (value ^ (value >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF
            found.append((value ^ (value >> 13)) & (language_id.BUCKETS - 1))
    return found


TEXTS = ["Hello, World", "à la carte — déjà vu", "x", "one  two\t\tthree", "1, 2, 3", "a-b-c", " lead and trail ", "日本語", "ümlaut! ÜBER", "a" * 3000]


@pytest.mark.parametrize("text", TEXTS)
def test_subwords_equal_one_byte_at_a_time(text):
    found = language_id.subwords(np.frombuffer(text.encode(), np.uint8))
    assert sorted(found.tolist()) == sorted(plain_subwords(text))


def test_predictions_equal_plain_python(spark):
    rng = random.Random(4)
    letters = {"aa": "abcde", "bb": "defgh", "cc": "ghijk"}
    rows = [
        (i, " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randint(1, 7))) for _ in range(30)), lang, "clash", "clash")
        for i, lang in enumerate(rng.choice(sorted(letters)) for _ in range(300))
    ]
    odd = [None, "", "123 !?", "ab gh", "zzz", "é", "ab", "ab"]
    rows += [(1000 + i, text, None, "clash", "clash") for i, text in enumerate(odd)]
    docs = prepared(spark).createDataFrame(rows, "doc_id long, text string, lang string, score string, at string")
    bags = [(*language_id.bag(text), lang) for _, text, lang, *_ in rows[:200]]
    model = language_id.train(bags)
    found = {r["doc_id"]: r for r in language_id.identified(docs, model).collect()}
    assert len(found) == len(rows)
    right = 0
    for doc_id, text, lang, *_ in rows:
        row = found[doc_id]
        if not any(c.isalpha() for c in text or ""):
            assert (row["lang_pred"], row["score"], row["rejected"]) == ("und", 0.0, True)
            continue
        ids = plain_subwords(text)
        mean = [math.fsum(float(model.table[i][d]) for i in ids) / max(1, len(ids)) for d in range(language_id.WIDTH)]
        logits = [
            math.fsum(mean[d] * float(model.weights[d][k]) for d in range(language_id.WIDTH)) + float(model.bias[k])
            for k in range(len(model.languages))
        ]
        grown = [math.exp((x - max(logits)) / model.temperature) for x in logits]
        sure = [x / sum(grown) for x in grown]
        best = max(range(len(sure)), key=sure.__getitem__)
        assert row["score"] == pytest.approx(sure[best], abs=1e-4)
        assert row["lang_pred"] == model.languages[best] or sorted(sure)[-1] - sorted(sure)[-2] < 1e-4
        assert row["rejected"] == (row["score"] < model.threshold)
        right += row["lang_pred"] == lang
    assert right >= 290


def test_repeated_rows_and_an_empty_table(spark):
    docs = prepared(spark).createDataFrame([(1, "ab cd", "aa")] * 3, "doc_id long, text string, lang string")
    model = language_id.train([(*language_id.bag("ab cd"), "aa")])
    assert [r["lang_pred"] for r in language_id.identified(docs, model).collect()] == ["aa"] * 3
    assert language_id.identified(docs.where("false"), model).count() == 0
