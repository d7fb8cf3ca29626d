"""Array elements of JSON documents read in splits, against a parser that reads the whole document."""

import json
import random

import pytest

from kpiloom.sources import chat, elements


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def text(rng):
    signs = ["a", "é", '"', "\\", "{", "}", "[", "]", ",", ":", "\n", ' "messages": [', '"}', "\\\\", "😀", " "]
    return "".join(rng.choices(signs, k=rng.randrange(14)))


def message(rng, number):
    parts = [{"type": rng.choice("bi"), "text": text(rng)} if rng.random() < 0.5 else text(rng) for _ in range(rng.randrange(4))]
    found = {"id": number, "author": rng.choice([None, text(rng)]), "text": rng.choice([text(rng), parts])}
    if rng.random() < 0.3:
        found["extra"] = {"messages": [{"id": 99}], "deep": [[{}], []]}
    return found


def document(rng, n):
    head = {"name": text(rng), "info": {"messages": [{"id": -1}], "x": text(rng)}}
    tail = {"other": {"k": {"z": [{"id": -2}]}}, "last": text(rng)}
    return {**(head if rng.random() < 0.8 else {}), "messages": [message(rng, k) for k in range(n)], **(tail if rng.random() < 0.7 else {})}


LAYOUTS = [{"separators": (",", ":")}, {}, {"indent": 1}, {"indent": 4, "separators": (" ,", " : ")}]


@pytest.mark.parametrize("layout", LAYOUTS, ids=str)
def test_elements_in_many_splits_equal_a_parser(spark, tmp_path, small_splits, layout):
    rng = random.Random(str(layout))
    expected = {}
    for name, n in {"a": 60, "b": 0, "c": 1, "d": 25, "e": 7}.items():
        whole = document(rng, n)
        (tmp_path / f"{name}.json").write_text(json.dumps(whole, ensure_ascii=rng.random() < 0.5, **layout), encoding="utf-8")
        expected.update({(f"{name}.json", k): m for k, m in enumerate(whole["messages"])})
    (tmp_path / "f.json").write_text('{"name": "no array", "x": [1, 2]}')
    rows = elements.array_elements(spark, str(tmp_path), "messages").collect()
    found = {(r["source_file"].rsplit("/", 1)[-1], r["number"]): json.loads(r["value"]) for r in rows}
    assert len(rows) == len(found) and found == expected


@pytest.mark.parametrize("seed", range(3))
def test_compact_and_indented_exports_give_the_same_messages(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    whole = document(rng, 40)
    rows = {}
    for name, layout in {"compact": LAYOUTS[0], "indented": {"indent": 1}}.items():
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(whole, ensure_ascii=False, **layout), encoding="utf-8")
        for read in (chat.exported_messages, chat.chat_messages, chat.split_chat_messages):
            found = read(spark, str(path))
            rows[name, read.__name__] = sorted(
                (r["id"], r["author"], r["text"].toJson() if r["text"] is not None else None) for r in found.collect()
            )
    first = rows["compact", "chat_messages"]
    assert len(first) > 30 and {name: found == first for name, found in rows.items()} == dict.fromkeys(rows, True)


def test_several_tasks_read_one_line(spark, tmp_path, small_splits):
    path = tmp_path / "line.json"
    path.write_text(json.dumps({"messages": [{"id": k, "text": "x" * 50} for k in range(200)]}, separators=(",", ":")))
    pieces = elements._pieces(spark, str(path))
    assert pieces.select("block").distinct().count() > 10
    assert chat.split_chat_messages(spark, str(path), intro=3).count() == 197
