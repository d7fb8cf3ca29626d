"""Stages of the pipeline on odd rows: clashing columns, repeated rows, rows without ids, empty tables."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kpiloom.llm import exact_dedup, language_id, near_dedup
from kpiloom.llm.common import prepared

FOLDER = "/root/testdata/sf0.01"
# Names that the operators use inside.
CLASHING = (
    "dropped_doc_id dropped_print dropped_id print repeated_doc_id kept keep_id at score n own block term rep key bands set_a "
    "n_shingles component_id words items spans n_hit toxic lang_pred piece length ids row chunk feature"
).split()
LONG = " ".join(f"word{k}" for k in range(300))
TEXTS = [
    (1, "the same text here"), (2, "the  same\ttext here"), (None, "the same text here"), (None, "only without an id"),
    (None, "only without  an id"), (5, None), (6, ""), (6, ""), (7, "repeated row"), (7, "repeated row"), (7, "other text of seven"),
    (8, LONG), (9, LONG + " end"), (10, " \n "), (11, "x" * 200_000), (12, "repeated row"), (12, "other text of seven"),
]


@pytest.fixture(scope="module")
def odd(spark):
    prepared(spark)
    rows = [(i, t, "en", "src", len(t or ""), *["clash"] * len(CLASHING)) for i, t in TEXTS]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(rows, schema)


def plain(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def rows_of(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_one_row_of_each_group_of_equal_texts_stays(odd, broadcast_rows):
    found = exact_dedup.first_of_equal(odd, broadcast_rows)
    assert found.columns == odd.columns
    kept = rows_of(found)
    best = {}
    for doc_id, text in TEXTS:
        key = plain(text)
        best[key] = min(best.get(key, (True, 0)), (doc_id is None, doc_id or 0))
    assert Counter({(None if none else i, key): 1 for key, (none, i) in best.items()}) == Counter(
        {(doc_id, plain(text)): n for (doc_id, text), n in kept.items()}
    )


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_keep_what_is_alone_and_all_columns(spark, odd, name, stage):
    alone = odd.where("doc_id IN (8, 11) OR text = 'only without an id'")
    found = stage(spark, alone, FOLDER)
    if name == "packing":
        assert {r["doc_id"] for r in found.collect()} == {8, 11, None}
    else:
        assert found.columns == odd.columns and found.collect() and rows_of(found) == rows_of(alone)
    whole = stage(spark, odd, FOLDER)
    assert {r["doc_id"] for r in whole.collect()} <= {i for i, _ in TEXTS}
    assert stage(spark, odd.limit(0), FOLDER).collect() == []


def test_similar_rows_leave_the_smallest_id(spark, odd):
    kept = rows_of(near_dedup.first_of_similar(odd))
    assert kept[8, LONG] and not kept[9, LONG + " end"]
    assert kept[None, "only without an id"] and kept[5, None] and kept[6, ""] == 2


def test_language_with_clashing_columns(spark, odd):
    found = language_id.language_id(odd.withColumn("at", F.lit(1)), F.lit(False)).collect()
    assert len(found) == len(TEXTS)
