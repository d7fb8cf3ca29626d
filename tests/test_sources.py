"""File sources and stage tables in temporary folders."""

import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from kpiloom import schemas
from kpiloom.operators.rows import first_rows
from kpiloom.plans.tickets import tickets
from kpiloom.sources import chat, config, database, files, reports

LAYOUT = "n INT, name STRING, amount DOUBLE"


def write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def stamp(path, moment):
    seconds = moment.replace(tzinfo=timezone.utc).timestamp()
    os.utime(path, (seconds, seconds))


def body(df):
    return [tuple(row) for row in df.orderBy("source_file", "block", "place").select("n", "name", "amount").collect()]


def test_report_with_preamble_and_footer(spark, tmp_path):
    path = write(tmp_path / "r.csv", ["Title", "n,name,amount", "sub header", '1,"a, b",1.5', "2,b,", "Total,,9", "Signed"])
    scanned = reports.report_scan(spark, path, LAYOUT, skip_rows=[0, 2], skip_footer=2)
    assert body(scanned) == [(1, "a, b", 1.5), (2, "b", None)]


def test_report_header_only(spark, tmp_path):
    path = write(tmp_path / "r.csv", ["n;name;amount", "1;a;1", "2;b;2"])
    assert body(reports.report_scan(spark, path, LAYOUT, separator=";")) == [(1, "a", 1.0), (2, "b", 2.0)]


def test_report_split_over_tasks(spark, tmp_path):
    rows = [f"{n},name {n},{n / 2}" for n in range(5000)]
    for number in range(2):
        write(tmp_path / f"big{number}.csv", ["t"] * 11 + ["head", "units"] + rows + ["foot"] * 3)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        scanned = reports.report_scan(spark, str(tmp_path), LAYOUT, skip_rows=[*range(11), 12], skip_footer=3)
        assert scanned.select("block").distinct().count() > 5
        found = body(scanned)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == [(n, f"name {n}", n / 2) for n in range(5000)] * 2


def test_report_shorter_than_its_preamble(spark, tmp_path):
    path = write(tmp_path / "r.csv", ["a", "b"])
    assert body(reports.report_scan(spark, path, LAYOUT, skip_rows=[0, 1, 2], skip_footer=2)) == []


HEADINGS = {"n": "Номер", "name": "Имя", "amount": "Сумма"}


def test_report_columns_by_heading(spark, tmp_path):
    write(tmp_path / "a.csv", ["t", "Номер,Имя,Сумма", "1,a,1.5"])
    write(tmp_path / "b.csv", ["t", "Сумма,Лишнее,Имя,Номер", "2.5,x,b,2", "3.5,y,c,3"])
    scanned = reports.report_scan(spark, str(tmp_path), LAYOUT, skip_rows=[0], headings=HEADINGS)
    assert body(scanned) == [(1, "a", 1.5), (2, "b", 2.5), (3, "c", 3.5)]


def test_report_without_a_wanted_heading_is_refused(spark, tmp_path):
    path = write(tmp_path / "a.csv", ["Номер,Имя", "1,a"])
    with pytest.raises(ValueError, match="Сумма"):
        reports.report_scan(spark, path, LAYOUT, headings=HEADINGS)


@pytest.mark.parametrize("lines", [["1,a"], ["1,a,1.5,more"], ["x,a,1.5"]])
@pytest.mark.parametrize("headings", [None, HEADINGS])
def test_records_that_do_not_parse_are_refused(spark, tmp_path, lines, headings):
    path = write(tmp_path / "a.csv", ["Номер,Имя,Сумма", "1,a,1.5", *lines])
    with pytest.raises(ValueError, match="does not parse"):
        reports.report_scan(spark, path, LAYOUT, headings=headings)


def test_many_reports_tagged_by_file(spark, tmp_path):
    write(tmp_path / "рег 1.csv", ["h", "1,a,1", "1,b,2"])
    write(tmp_path / "two.csv", ["h", "2,c,3"])
    write(tmp_path / "other.txt", ["h", "9,z,9"])
    scanned = reports.report_scan(spark, str(tmp_path), LAYOUT, columns=["n", "amount"], name_part=".csv")
    tagged = reports.tag_by_file(reports.with_sequence(scanned), {"рег 1.csv": "Unit 1"})
    assert {tuple(row) for row in tagged.select("department", "n", "amount").collect()} == {
        ("Unit 1", 1, 1.0), ("Unit 1", 1, 2.0), (None, 2, 3.0),
    }
    # The sequence is an order column for first-row rules.
    first = first_rows(tagged, ["n"], ["seq"])
    assert {(row["n"], row["amount"]) for row in first.collect()} == {(1, 1.0), (2, 3.0)}


def test_csv_scan(spark, tmp_path):
    path = write(tmp_path / "v.csv", ["a,b", "1,x", "2,"])
    assert [tuple(row) for row in reports.csv_scan(spark, path, "a INT, b STRING").collect()] == [(1, "x"), (2, None)]


@pytest.mark.parametrize("read", [chat.chat_messages, chat.indented_chat_messages])
def test_chat_export(spark, tmp_path, read):
    intro = [{"id": n, "author": "a", "text": "Заявка №1"} for n in range(3)]
    messages = intro + [
        {"id": 3, "type": "service", "text": "Заявка №2"},
        {"id": 4, "author": "b", "text": ["Заявка № 5 ", {"type": "hashtag", "text": "#ОСП 2"}, "\n  }\n  {\n#Решена"], "extra": [{"x": 1}]},
        {"id": 5, "author": "c", "text": "Заявка №6"},
    ]
    path = tmp_path / "chat.json"
    path.write_text(json.dumps({"name": "x", "messages": messages, "more": {}}, ensure_ascii=False, indent=1), encoding="utf-8")
    found = tickets(read(spark, str(path)), link_base="")
    assert {tuple(row) for row in found.select("number", "url", "status", "group", "text").collect()} == {
        (5, "4", "Решено", "ОСП_2", "Заявка №5 #ОСП_2   }   { #Решено"), (6, "5", "Открыто", "", "Заявка №6"),
    }


@pytest.mark.parametrize("indent", [1, 2, 3, 4, None])
def test_any_layout_of_an_export_gives_the_same_messages(spark, tmp_path, indent):
    messages = [{"id": n, "author": "a", "text": "Заявка №1\n {"} for n in range(10)]
    path = tmp_path / "chat.json"
    path.write_text(json.dumps({"name": "x", "messages": messages}, ensure_ascii=False, indent=indent), encoding="utf-8")
    assert sorted(row["id"] for row in chat.exported_messages(spark, str(path)).collect()) == list(range(3, 10))


def test_indented_export_is_read_in_parallel(spark, tmp_path):
    messages = [{"id": n, "author": "a", "text": ["Заявка №", {"type": "bold", "text": f"{n} " + "слово " * (n % 50)}]} for n in range(2000)]
    path = tmp_path / "chat.json"
    path.write_text(json.dumps({"messages": messages}, ensure_ascii=False, indent=1), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        split = chat.indented_chat_messages(spark, str(path))
        whole = chat.chat_messages(spark, str(path))
        assert {row["id"] for row in split.select("id").collect()} == set(range(3, 2000))
        found = [{tuple(row) for row in tickets(read, link_base="").collect()} for read in (split, whole)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found[0] == found[1] and len(found[0]) == 1997


def test_choosing_files(spark, tmp_path):
    now = datetime(2024, 1, 10, 12)
    for name, hours, size in (("report old.csv", 13, 50), ("report new.csv", 11, 50), ("report last.csv", 1, 5), ("other.csv", 0, 50)):
        path = tmp_path / name
        path.write_text("x" * size)
        stamp(path, now - timedelta(hours=hours))
    folder = str(tmp_path)

    def names(df):
        return {row["path"].rsplit("/", 1)[1].replace("%20", " ") for row in df.collect()}

    assert names(files.listed_files(spark, folder, "report")) == {"report old.csv", "report new.csv", "report last.csv"}
    assert names(files.fresh_files(spark, folder, "report", as_of=now)) == {"report new.csv", "report last.csv"}
    assert names(files.fresh_files(spark, folder, "report", as_of=now, hours=4)) == {"report last.csv"}
    assert names(files.fresh_files(spark, folder, "report", as_of=now, min_bytes=20)) == {"report new.csv"}
    assert files.newest_file(files.listed_files(spark, folder, "report")).endswith("last.csv")
    assert files.newest_file(files.fresh_files(spark, folder, as_of=now + timedelta(days=9))) is None


def test_only_the_newest_report_is_read(spark, tmp_path):
    now = datetime(2024, 1, 10, 12)
    for name, hours, rows in (("report 1.csv", 30, ["1,old,1"]), ("report [2].csv", 3, ["2,new,2"]), ("other.csv", 0, ["3,other,3"])):
        write(tmp_path / name, ["n,name,amount", *rows])
        stamp(tmp_path / name, now - timedelta(hours=hours))
    folder = str(tmp_path)
    assert body(reports.report_scan(spark, files.Newest(folder, "report"), LAYOUT)) == [(2, "new", 2.0)]
    fresh = files.Newest(folder, "report", as_of=now, hours=4, min_bytes=10)
    assert body(reports.report_scan(spark, fresh, LAYOUT)) == [(2, "new", 2.0)]
    for refused in (
        files.Newest(folder, "report", as_of=now + timedelta(hours=2), hours=4),
        files.Newest(folder, "report", min_bytes=10_000),
        files.Newest(folder, "absent"),
    ):
        with pytest.raises(ValueError):
            reports.report_scan(spark, refused, LAYOUT)


def test_age_limit_is_inclusive(spark, tmp_path):
    now = datetime(2024, 1, 10, 12)
    path = tmp_path / "a.csv"
    path.write_text("x")
    stamp(path, now - timedelta(hours=12))
    assert files.fresh_files(spark, str(tmp_path), as_of=now).count() == 1
    stamp(path, now - timedelta(hours=12, seconds=1))
    assert files.fresh_files(spark, str(tmp_path), as_of=now).count() == 0


def test_stage_table_is_reused_while_fresh(spark, tmp_path):
    path = str(tmp_path / "stage")
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    now = datetime.now(timezone.utc).replace(tzinfo=None)
    assert files.staged(spark, path, build, as_of=now).count() == 3
    assert files.staged(spark, path, build, as_of=now + timedelta(hours=11)).count() == 3
    assert len(calls) == 1
    assert files.staged(spark, path, build, as_of=now + timedelta(hours=13)).count() == 3
    assert len(calls) == 2


def test_config_table(spark):
    df = config.config_table(spark, {"a": 1.5, "b": 2.5}, "unit STRING, weight DOUBLE")
    assert {tuple(row) for row in df.collect()} == {("a", 1.5), ("b", 2.5)}
    assert config.config_table(spark, {}, "unit STRING, weight DOUBLE").count() == 0
    big = spark.range(10).select(F.col("id").cast("string").alias("unit"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = big.join(df, "unit")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "LocalTableScan" in plan and "BroadcastHashJoin" in plan


def test_database_options():
    settings = {"url": "jdbc:x", "user": "u", "password": "p", "unused": 1}
    assert database.connection_options(settings) == {"url": "jdbc:x", "user": "u", "password": "p"}
    assert database.Split("id", 0, 100, 4).options() == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4",
    }


@pytest.mark.parametrize("layout", [value for name, value in vars(schemas).items() if name.isupper()])
def test_layouts_are_valid(spark, layout):
    assert spark.createDataFrame([], layout).columns


def test_newest_file_of_every_unit(spark, tmp_path):
    now = datetime(2024, 1, 10, 12)
    for unit, names in {"рег 1": ("old", "new"), "50% +x": ("old", "new"), "two": ("new",)}.items():
        for name in names:
            path = tmp_path / unit / f"{name} export.csv"
            path.parent.mkdir(exist_ok=True)
            write(path, ["n,name,amount", f"{len(unit)},{name},1.5"])
            stamp(path, now - timedelta(hours=1 if name == "new" else 30))
    write(tmp_path / "two" / "note.txt", ["x"])
    write(tmp_path / "loose export.csv", ["n,name,amount", "0,loose,0"])
    source = files.NewestPerUnit(str(tmp_path), r"^([^/]+)/[^/]+$", "export", as_of=now, hours=4)
    assert set(files.paths_per_unit(spark, source)) == {"рег 1", "50% +x", "two"}
    scanned = reports.report_scan(spark, source, LAYOUT)
    assert sorted(body(scanned)) == [(3, "new", 1.5), (5, "new", 1.5), (6, "new", 1.5)]
    tagged = reports.tag_by_unit(scanned, source, {"рег 1": "Unit 1", "50% +x": "Unit 2"})
    assert {(r["n"], r["department"]) for r in tagged.collect()} == {(5, "Unit 1"), (6, "Unit 2"), (3, None)}
    # Units come from the name as well.
    by_name = files.NewestPerUnit(str(tmp_path), r"(old|new) export", "export")
    assert set(files.paths_per_unit(spark, by_name)) == {"old", "new"}


def test_all_stale_and_missing_units_are_named(spark, tmp_path):
    now = datetime(2024, 1, 10, 12)
    for unit, hours in {"a": 1, "b": 5, "c": 9, "d": 1}.items():
        path = tmp_path / f"{unit}_export.csv"
        write(path, ["n,name,amount", "1,x,1"] if unit != "d" else ["n"])
        stamp(path, now - timedelta(hours=hours))
    source = files.NewestPerUnit(
        str(tmp_path), r"^([^_]+)_", units=frozenset("abcdx"), as_of=now, hours=4, min_bytes=10
    )
    with pytest.raises(ValueError, match="for: b, c, d, x$"):
        reports.report_scan(spark, source, LAYOUT)
    fine = files.NewestPerUnit(str(tmp_path), r"^([^_]+)_", units=frozenset("a"), as_of=now, hours=4)
    assert body(reports.report_scan(spark, fine, LAYOUT)) == [(1, "x", 1.0)]
    with pytest.raises(ValueError, match="all units"):
        files.paths_per_unit(spark, files.NewestPerUnit(str(tmp_path), r"^([^_]+)_", "absent"))


def test_stage_follows_its_files_not_their_age(spark, tmp_path):
    source, stage, built = tmp_path / "in", str(tmp_path / "stage"), []
    source.mkdir()
    write(source / "a.csv", ["1", "2"])
    write(source / "b.csv", ["3"])

    def build():
        built.append(1)
        return spark.read.text(str(source))

    def rows():
        return sorted(r["value"] for r in files.staged_by_content(spark, stage, build, str(source)).collect())

    assert rows() == ["1", "2", "3"] and rows() == ["1", "2", "3"] and len(built) == 1
    write(source / "a.csv", ["5", "6"])  # the same length at another time
    stamp(source / "a.csv", datetime(2024, 1, 1))
    assert rows() == ["3", "5", "6"] and len(built) == 2
    stamp(source / "a.csv", datetime(2020, 1, 1))
    assert rows() == ["3", "5", "6"] and len(built) == 3  # an older file has replaced it
    (source / "b.csv").unlink()
    assert rows() == ["5", "6"] and rows() == ["5", "6"] and len(built) == 4
    assert len([name for name in os.listdir(stage) if not name.startswith(".")]) == 1
    # A stage that was not written to the end does not count.
    (folder,) = os.listdir(stage)
    os.remove(os.path.join(stage, folder, "_SUCCESS"))
    assert rows() == ["5", "6"] and len(built) == 5
