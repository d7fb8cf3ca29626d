"""Records over several lines, read in splits, against a reader that goes through the file once."""

import csv
import random

import pytest

from kpiloom.sources import records, reports


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def written(path, rows, separator=","):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, delimiter=separator, lineterminator="\n").writerows(rows)
    return str(path)


def random_rows(rng, n):
    def field():
        return "".join(rng.choices(["a", "é", '"', '""', ",", ";", "\n", " ", "\n\n", "text "], [9, 1, 1, 0.5, 1, 1, 1, 3, 0.3, 5], k=rng.randrange(9)))

    return [[str(k), field(), field()] for k in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_records_in_many_splits_equal_one_reader(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    expected = []
    for number in range(3):
        rows = random_rows(rng, 120)
        path = written(tmp_path / f"f{number}.csv", [["n", "a", "b"], *rows], ";" if seed == 3 else ",")
        with open(path, newline="", encoding="utf-8") as file:
            expected += [(int(n), a or None, b or None) for n, a, b in list(csv.reader(file, delimiter=";" if seed == 3 else ","))[1:]]
    found = reports.report_scan(spark, str(tmp_path), "n INT, a STRING, b STRING", separator=";" if seed == 3 else ",")
    assert found.select("block").distinct().count() > 5
    rows = [tuple(row) for row in found.orderBy("source_file", "block", "place").select("n", "a", "b").collect()]
    assert [(n, a, b) for n, a, b in rows] == expected


def test_a_quote_inside_a_plain_field_opens_nothing(spark, tmp_path, small_splits):
    lines = ['Report of 5" pipes, all', "n,a,b", '1,6" wide,x', '2,"two', 'lines",y', '3,say "no",z', '4,"a ""b""",w', '5,"",v']
    path = tmp_path / "r.csv"
    path.write_text("\n".join([*lines, *[f"{k},p,q" for k in range(6, 200)]]) + "\n", encoding="utf-8")
    found = reports.report_scan(spark, str(path), "n INT, a STRING, b STRING", skip_rows=[0])
    rows = [tuple(row) for row in found.orderBy("block", "place").select("n", "a", "b").collect()]
    assert rows[:5] == [(1, '6" wide', "x"), (2, "two\nlines", "y"), (3, 'say "no"', "z"), (4, 'a "b"', "w"), (5, None, "v")]
    assert rows[5:] == [(k, "p", "q") for k in range(6, 200)]


def test_preamble_and_footer_count_records(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('"Title\nover lines"\nn,a\n1,"x\ny"\n2,z\n"Total\nof all",9\n', encoding="utf-8")
    found = reports.report_scan(spark, str(path), "n INT, a STRING", skip_rows=[0], skip_footer=1)
    assert [(r["n"], r["a"]) for r in found.orderBy("block", "place").collect()] == [(1, "x\ny"), (2, "z")]


def test_an_open_field_and_a_too_long_record_are_refused(spark, tmp_path):
    path = tmp_path / "open.csv"
    path.write_text('n,a\n1,"x\n2,y\n3,z\n', encoding="utf-8")
    with pytest.raises(ValueError, match="open.csv has a quoted field that is open to the end: 3 lines"):
        records.numbered_records(spark, str(path))
    path.write_text('n,a\n1,"xxxxxxxxxx\nyyyyyyyyyyyy"\n3,z\n', encoding="utf-8")
    with pytest.raises(ValueError, match="longer than allowed"):
        records.numbered_records(spark, str(path), longest=15)


def test_states_follow_what_lines_do(spark):
    """All four kinds of lines in random order over blocks of random size."""
    rng = random.Random(2)
    rows, expected = [], {}
    for file in ("a", "b", "c"):
        inside, place = False, rng.randrange(100)
        for block in sorted(rng.sample(range(1000), 12)):
            for _ in range(rng.choice([1, 1, 2, 9])):
                kind = rng.choices([(False, True), (True, False), (False, False), (True, True)], [6, 3, 1, 1])[0]
                rows.append((file, block, place, *kind))
                expected[file, place] = inside
                inside = kind[1] if inside else kind[0]
                place += 1
    steps = spark.createDataFrame(rows, "source_file string, block long, place long, after_outside boolean, after_inside boolean")
    assert {(r["source_file"], r["place"]): r["inside"] for r in records.states(steps).collect()} == expected
