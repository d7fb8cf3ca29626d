"""The pipeline's stages against plain Python, and the registered queries."""

from collections import Counter

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries

FOLDER = "/root/testdata/sf0.01"


def test_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "near_dedup", "decontamination", "packing",
    ]
    assert sum(name.startswith("op") and name[2].isdigit() for name in queries()) == 13
    assert "pipeline" in queries() and "op10_exact_dedup" in oracle_sql()


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tables = [pq.read_table(f"{FOLDER}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        tables.append(docs.toArrow())
    return tables


def test_each_stage_drops_what_it_should_and_nothing_else(stages):
    from test_text_operators import brute_components, brute_groups, brute_hits

    rows = [sorted(t.to_pylist(), key=lambda r: r["doc_id"]) for t in stages[:5]]
    assert all(r == o for step in rows[1:] for r, o in zip(step, [r for r in rows[0] if r["doc_id"] in {s["doc_id"] for s in step}]))
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{FOLDER}/labels.parquet").to_pylist()}
    gone = {r["doc_id"] for r in rows[0]} - {r["doc_id"] for r in rows[1]}
    wrong = sum((doc_id in gone) != bool(toxic) for doc_id, toxic in labels.items())
    assert wrong < 0.03 * len(labels)

    texts = [r["text"] for r in rows[1]]
    keep = {rows[1][i]["doc_id"] for i, (first, *_) in brute_groups(texts).items() if first == i}
    assert {r["doc_id"] for r in rows[2]} == keep

    component, _ = brute_components([r["text"] for r in rows[2]])
    assert {r["doc_id"] for r in rows[3]} == {rows[2][k]["doc_id"] for k in set(component)}

    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()]
    clean = set()
    for r in rows[3]:
        n_words, n_hit, _ = brute_hits(r["text"], items)
        if not (n_hit and 20 * n_hit >= n_words):
            clean.add(r["doc_id"])
    assert {r["doc_id"] for r in rows[4]} == clean
    packed = stages[5].to_pylist()
    assert {r["doc_id"] for r in packed} == clean
    assert all(0 < r["length"] <= 2048 for r in packed)


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    found = corpus_pipeline.run(spark, FOLDER).select("doc_id", "piece", "ids_crc32").collect()
    expected = stages[5].select(["doc_id", "piece", "ids_crc32"]).to_pylist()
    assert Counter(map(tuple, found)) == Counter(tuple(r.values()) for r in expected)
