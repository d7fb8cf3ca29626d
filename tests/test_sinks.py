"""Writers in temporary folders."""

import csv
import os
import random
from datetime import date

from pyspark.sql import functions as F

from kpiloom import schemas
from kpiloom.operators.aggregates import labelled_totals
from kpiloom.sinks import tables

THURSDAY, FRIDAY = date(2024, 1, 11), date(2024, 1, 12)


def as_set(df):
    return {tuple(row) for row in df.collect()}


def test_csv_and_parquet_are_replaced(spark, frame, tmp_path):
    for content in ("old", "new"):
        df = frame("a STRING, b INT", (content, 1))
        tables.write_csv(df, str(tmp_path / "c"))
        tables.replace_table(df, str(tmp_path / "p"))
    assert as_set(spark.read.option("header", True).csv(str(tmp_path / "c"))) == {("new", "1")}
    assert as_set(tables.published_table(spark, str(tmp_path / "p"))) == {("new", 1)}


def test_one_folder_per_unit(spark, frame, tmp_path):
    # Two units that agree in their first 21 characters stay apart.
    long = "Приемное отделение №1 (стационар) "
    df = frame("unit STRING, doctor STRING, n INT", (long + "A", "b", 1), (long + "A", "a", 2), (long + "B", "c", 3), (long + "A", None, 4))
    path = str(tmp_path / "units")
    tables.write_by_unit(df, path, "unit", order=["doctor"], fmt="parquet")
    assert len([name for name in os.listdir(path) if name.startswith("unit=")]) == 2
    back = spark.read.parquet(path)
    assert as_set(back.select("unit", "doctor", "n")) == as_set(df)
    assert [row["n"] for row in back.where(F.col("unit") == long + "A").collect()] == [2, 1, 4]


def test_a_large_unit_is_in_order_over_its_files(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"u{min(9, k % 30)}", rng.choice([None, *"abcdefgh"]), rng.randrange(10**6), k) for k in range(20_000)]
    rows += [("u9", "hot", 1, 10**6 + k) for k in range(20_000)]
    path = str(tmp_path / "units")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "unit STRING, doctor STRING, value INT, n INT")
        tables.write_by_unit(df.repartition(6), path, "unit", order=["doctor", "value"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = 0
    for unit in {row[0] for row in rows}:
        names = sorted(name for name in os.listdir(f"{path}/unit={unit}") if name.endswith(".csv"))
        found = []
        for name in names:
            with open(f"{path}/unit={unit}/{name}", newline="") as file:
                found += list(csv.reader(file))[1:]
        keys = [(doctor == "", doctor, int(value)) for doctor, value, _ in found]
        assert keys == sorted(keys)
        back += len(found)
        if unit == "u9":
            sizes = [sum(1 for _ in open(f"{path}/unit=u9/{name}")) for name in names]
            assert len(names) > 3 and max(sizes) < 0.5 * sum(sizes)  # the hot doctor is in several files
    assert back == len(rows)


def test_only_written_partitions_are_replaced(spark, frame, tmp_path):
    path = str(tmp_path / "days")
    tables.replace_partitions(frame("day STRING, n INT", ("a", 1), ("b", 2)), path, "day")
    tables.replace_partitions(frame("day STRING, n INT", ("b", 3)), path, "day")
    assert as_set(spark.read.parquet(path).select("day", "n")) == {("a", 1), ("b", 3)}


def history_row(unit, week, fact):
    return unit, week, week, 10, fact, 50.0


def test_history_is_only_extended(spark, frame, tmp_path):
    path = str(tmp_path / "history")
    keys = ["unit", "period_start"]
    first, second = date(2024, 1, 1), date(2024, 1, 8)
    published = frame(schemas.HISTORY, history_row("A", first, 5), history_row("B", first, 6))
    assert not tables.append_history(published, path, schemas.HISTORY, keys, as_of=FRIDAY)
    assert tables.append_history(published, path, schemas.HISTORY, keys, as_of=THURSDAY)
    later = frame(schemas.HISTORY, history_row("A", first, 99), history_row("A", second, 7))
    for _ in range(2):
        assert tables.append_history(later, path, schemas.HISTORY, keys, as_of=THURSDAY)
    stored = tables.stored_history(spark, path, schemas.HISTORY)
    assert sorted(tuple(row) for row in stored.collect()) == sorted(
        [history_row("A", first, 5), history_row("B", first, 6), history_row("A", second, 7)]
    )


def test_labelled_totals(frame):
    assert as_set(labelled_totals(frame("a BIGINT, b BIGINT", (1, 2)), {"a": "yes", "b": "no"})) == {("yes", 1), ("no", 2)}
