"""Runs and outlines of the toxicity operator: linear time, and no reading lost by what is not decoded."""

import random
import time

import pytest

from kpiloom.llm import toxicity

LONG = [
    "-" * 80 + "Begin", "." * 10_000, "-" * 10_000 + "x", "_" * 10_000 + " a", ".-_" * 10_000 + "word", "- " * 10_000,
    "a. " * 10_000 + "bb", "a-" * 10_000 + "b", "a " * 10_000, "a_b" * 10_000, "aa.b " * 10_000, "..a" * 10_000, " " * 10_000 + "x",
]


@pytest.fixture(scope="module")
def costs():
    rng = random.Random(3)
    return [rng.uniform(0.1, 8) for _ in range(toxicity._SIZE**3)]


@pytest.mark.parametrize("text", LONG)
def test_separators_take_linear_time(costs, text):
    scorer = toxicity.Scorer(toxicity.ToxicityModel(costs, {"badword ": 3.0, "badw": 2.0}))
    start = time.perf_counter()
    scorer.score(text)
    toxicity.features_of(text, costs)
    assert time.perf_counter() - start < 1


@pytest.mark.parametrize(
    "text, runs",
    [
        ("say b a d w o r d now", ["b a d w o r d"]),
        ("b.a.d word", ["b.a.d"]),
        ("b - a -- d", ["b - a -- d"]),
        ("a b-c d-ex", ["a b-c"]),
        ("a b", []),
        ("it is b.a.dly", []),
        ("x.y.z. end", []),
        ("a    b    c", []),
        ("a .... b .... c", ["a .... b .... c"]),
        ("", []),
    ],
)
def test_runs_of_spaced_letters(text, runs):
    assert list(toxicity.spaced_runs(text)) == runs


def test_what_is_not_decoded_holds_no_feature(costs):
    words = ["idiot", "stupid", "loser", "moron", "scum"]
    weights = dict.fromkeys([w + " " for w in words] + [w[:k] for w in words for k in (4, 5) if len(w) > k], 1.0)
    signs = "abdeilmnorstuäñ013456789@$!|+(*#%& .-_,'~аеорсιντ?x"
    rng, seen = random.Random(5), 0
    model = toxicity.ToxicityModel(costs, weights)
    for _ in range(8000):
        word = list(rng.choice(words))
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(word))
            shown = [sign for sign, letters in toxicity.DISGUISES.items() if word[at] in letters]
            if rng.random() < 0.5 and shown:
                word[at] = rng.choice(shown)
            else:
                word.insert(at, rng.choice([word[at], rng.choice(signs)]))
        text = rng.choice(["", " ", "."]).join(word)
        every = {f for f in toxicity.features_of(text, costs) if f in weights}
        seen += bool(every)
        assert toxicity.Scorer(model).features(text) == every
    assert seen > 1000
