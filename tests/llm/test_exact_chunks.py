"""Exact duplicates of long texts: chunk rows, combined by text, give the same groups."""

import hashlib
import random
import re

import numpy as np
import pytest

from kpiloom.llm import exact_dedup
from kpiloom.llm.common import prepared

SCHEMA = "doc_id long, text string, row string, chunk string, print string"


@pytest.fixture(scope="module")
def long_texts():
    rng = random.Random(9)
    words = [rng.choice(["alpha", "beta", "ünï", "x\t\ty", "\n", "  "]) + str(rng.randrange(50)) for _ in range(60_000)]
    one = " ".join(words)
    last = one[:-1] + "!"
    middle = one[:200_000] + "#" + one[200_001:]
    chunk = "c" * exact_dedup.CHUNK
    return [one, one.replace(" ", " \n"), last, middle, chunk, chunk + "d", chunk * 2, chunk * 2, "", None, " ", "short", "short", one]


def plain(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


@pytest.mark.parametrize("long_bytes", [0, 1, exact_dedup.CHUNK, exact_dedup.LONG])
def test_prints_do_not_depend_on_where_chunks_are_hashed(spark, long_texts, long_bytes):
    rows = [(i, text, "clash", "clash", "clash") for i, text in enumerate(long_texts)]
    docs = prepared(spark).createDataFrame(rows, SCHEMA).repartition(3)
    found = {r["doc_id"]: r for r in exact_dedup.fingerprints(docs, long_bytes=long_bytes).collect()}
    assert len(found) == len(rows)
    for i, text in enumerate(long_texts):
        data = plain(text).encode()
        assert found[i]["print"] == exact_dedup.fingerprint(np.frombuffer(data, np.uint8))
        assert (found[i]["n_bytes"], found[i]["text_sha256"]) == (len(data), hashlib.sha256(data).hexdigest())


@pytest.mark.parametrize("prime, long_bytes", [(exact_dedup.PRIME, 1), (3, 1), (3, exact_dedup.CHUNK)])
def test_groups_of_long_texts_equal_brute_force(spark, long_texts, prime, long_bytes):
    rows = [(i, text, "clash", "clash", "clash") for i, text in enumerate(long_texts)]
    docs = prepared(spark).createDataFrame(rows, SCHEMA)
    same = {}
    for i, text in enumerate(long_texts):
        same.setdefault(plain(text), []).append(i)
    for r in exact_dedup.exact_groups(docs, prime, long_bytes=long_bytes).collect():
        group = same[plain(long_texts[r["doc_id"]])]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (group[0], len(group), r["doc_id"] == group[0])


def test_repeated_rows_and_rows_without_an_id(spark, long_texts):
    one = long_texts[0]
    rows = [(1, one), (1, one), (None, one), (1, one + "x"), (None, None)]
    docs = prepared(spark).createDataFrame(rows, "doc_id long, text string")
    found = exact_dedup.exact_groups(docs, long_bytes=1).collect()
    assert sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"], r["kept"] or False) for r in found) == [
        (0, 0, 1, False), (0, 1, 3, False), (1, 1, 1, True), (1, 1, 3, True), (1, 1, 3, True),
    ]
    empty = docs.where("false")
    assert exact_dedup.exact_groups(empty, long_bytes=1).count() == 0
