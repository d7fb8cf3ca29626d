"""Figures kept from run to run against full runs, balanced ranges, positions, skipped rows."""

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from kpiloom.operators import incremental as I
from kpiloom.operators.rows import skip_first
from kpiloom.operators.running import positions
from kpiloom.plans.recency import PERSON, latest_visits
from kpiloom.sinks import versions
from kpiloom.sinks.tables import replace_partitions
from kpiloom.sources.database import balanced_ranges

CARDS = "unit STRING, doctor STRING, card STRING, day DATE"
STORE = "day DATE, digest STRING, unit STRING, cards BIGINT"


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def count(df):
    return df.where("unit IS NOT NULL").groupBy("day", "unit").agg(F.count("card").alias("cards"))


def figures(df):
    return rows_of(df.where("cards IS NOT NULL").select("day", "unit", "cards"))


def test_days_are_counted_again_only_when_they_changed(spark, tmp_path):
    rng, path = random.Random(3), str(tmp_path / "store")
    days = [None, *[date(2024, 1, 1) + timedelta(days=k) for k in range(12)]]
    rows = [(rng.choice([None, "A", "B"]), "d", str(k), rng.choice(days)) for k in range(200)]
    counted = []

    def run(rows):
        df = spark.createDataFrame(rows, CARDS)

        def counting(part):
            counted.append({r["day"] for r in part.select("day").distinct().collect()})
            return count(part)

        stored = versions.published(spark, path, STORE)
        found = I.refreshed_days(df, "day", I.row_digests(df, "day"), stored, counting)
        versions.publish(found, path)
        return figures(versions.published(spark, path, STORE)), figures(count(df))

    ours, full = run(rows)
    assert ours == full and counted.pop() == {r[3] for r in rows}
    assert run(list(reversed(rows)))[0] == full and not counted  # the same rows in another order
    for step in range(6):
        before = Counter(rows)
        change = rng.choice(["late", "gone", "other", "day"])
        if change == "late":
            rows = [*rows, ("C", "d", f"late{step}", rng.choice(days)), rows[0]]
        elif change == "gone":
            rows = rng.sample(rows, len(rows) - 3)
        elif change == "other":
            rows = [("B", *rows[5][1:]) if k == 5 else row for k, row in enumerate(rows)]
        else:
            rows = [row for row in rows if row[3] != days[step + 2]]
        changed = {row[3] for row in (Counter(rows) - before) + (before - Counter(rows))} & {row[3] for row in rows}
        ours, full = run(rows)
        assert ours == full
        assert (counted.pop() if counted else set()) == changed


def test_unchanged_folders_are_not_read(spark, tmp_path):
    path = str(tmp_path / "cards")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    rows = [("A", "d", f"{k}", date(2024, 1, 1 + k % 9)) for k in range(90)]
    replace_partitions(spark.createDataFrame(rows, CARDS), path, "day")
    first = I.refreshed_days(spark.read.parquet(path), "day", I.file_digests(spark, path, "day"), spark.createDataFrame([], STORE), count)
    versions.publish(first, str(tmp_path / "store"))
    replace_partitions(spark.createDataFrame([("Z", "d", "x", date(2024, 1, 4))], CARDS), path, "day")
    df, stored = spark.read.parquet(path), versions.published(spark, str(tmp_path / "store"), STORE)
    read = []

    def counting(part):
        read.extend(sorted({row["day"] for row in part.select("day").distinct().collect()}))
        assert len(part.inputFiles()) > 1  # the table has them all, of which the scan takes the changed ones
        scan = part._jdf.queryExecution().executedPlan().toString().partition("PartitionFilters: [")[2]
        assert "day" in scan.partition("]")[0]
        return count(part)

    second = I.refreshed_days(df, "day", I.file_digests(spark, path, "day"), stored, counting)
    assert figures(second) == figures(count(df)) and read == [date(2024, 1, 4)]


def test_many_changed_days_are_joined(spark, monkeypatch):
    rows = [("A", "d", f"{k}", None if k % 7 == 0 else date(2024, 1, 1 + k % 20)) for k in range(100)]
    df = spark.createDataFrame(rows, CARDS)
    days = I.row_digests(df, "day").where("day IS NULL OR day > DATE '2024-01-05'")
    once = rows_of(I.only_days(df, "day", days))
    monkeypatch.setattr(I, "LISTED_DAYS", 3)
    assert rows_of(I.only_days(df, "day", days)) == once == rows_of(df.where("day IS NULL OR day > DATE '2024-01-05'"))


VISITS = (
    "tap_number STRING, tap_date DATE, mkab_number STRING, last_name STRING, first_name STRING, middle_name STRING, birth_year INT"
)


@pytest.mark.parametrize("seed", range(3))
def test_latest_visits_equal_a_full_run_over_random_changes(spark, frame, seed):
    rng = random.Random(seed)
    columns = [name.split()[0] for name in VISITS.split(", ")]

    def visit(number):
        name = rng.choice([None, "Ann", "Bob", "Eve"])
        return f"{number:05d}", date(2024, 1, rng.randrange(1, 29)), f"m{name}", name, "x", rng.choice([None, "y"]), rng.choice([1990, None])

    state = {f"{k:05d}": visit(k) for k in range(60)}
    stored = frame(VISITS, *[tuple(r) for r in latest_visits(frame(VISITS, *state.values())).select(*columns).collect()])
    number = 60
    for _ in range(5):
        added, gone = {}, []
        latest_keys = [r["tap_number"] for r in stored.collect()]
        for _ in range(rng.randrange(6)):
            added[f"{number:05d}"] = visit(number)
            number += 1
        for key in rng.sample(sorted(state), 4) + rng.sample(latest_keys, min(2, len(latest_keys))):
            if key in state:
                gone.append(key)
                if rng.random() < 0.5:
                    added[key] = visit(int(key))
        for key in gone:
            state.pop(key, None)
        state.update(added)
        rows = frame(VISITS, *state.values())
        found = I.refreshed_latest(
            stored, rows, frame(VISITS, *added.values()), frame("tap_number STRING", *[(key,) for key in gone]),
            person=PERSON, key="tap_number", latest=latest_visits,
        ).select(*columns)
        expected = latest_visits(rows).select(*columns)
        assert rows_of(found) == rows_of(expected)
        stored = frame(VISITS, *[tuple(r) for r in found.collect()])


def test_only_additions_do_not_read_all_rows(frame):
    row = ("1", date(2024, 1, 1), "m", "A", "b", None, 1990)
    later = ("2", date(2024, 1, 2), "m", "A", "b", None, 1990)
    broken = frame(VISITS, row).withColumn("tap_date", F.raise_error(F.lit("read")).cast("date"))
    found = I.refreshed_latest(
        frame(VISITS, row), broken, frame(VISITS, later), frame("tap_number STRING", ("9",)),
        person=PERSON, key="tap_number", latest=latest_visits,
    )
    assert [r["tap_number"] for r in found.collect()] == ["2"]


@pytest.mark.parametrize("kind", ["int", "double", "date", "timestamp", "decimal(12,2)"])
@pytest.mark.parametrize("shape", ["even", "gaps", "hot", "few", "one", "none"])
def test_every_row_is_in_one_range(spark, tmp_path, kind, shape):
    rng = random.Random(shape)
    keys = {
        "even": list(range(3000)),
        "gaps": [k if k < 1500 else 150_000 + 13 * k for k in range(3000)],
        "hot": [500] * 1500 + list(range(1500)),
        "few": [1, 2, 3] * 100, "one": [7] * 50, "none": [],
    }[shape]
    number = F.col("n").cast("int")
    cast = {
        "int": number, "double": number / 7, "decimal(12,2)": (number / 7).cast("decimal(12,2)"),
        "date": F.date_add(F.lit(date(1990, 1, 1)), number % 200_000), "timestamp": F.timestamp_seconds(number * 3.7),
    }[kind]
    rows = [(k,) for k in [*keys, *[None] * 40]]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "n INT").select(cast.alias("k")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    ranges = balanced_ranges(df, "k", 8)
    counts = [df.where(predicate).count() for predicate in ranges]
    held = [F.coalesce(F.expr(predicate), F.lit(False)).cast("int") for predicate in ranges]
    assert df.select(sum(held, F.lit(0)).alias("n")).where("n <> 1").isEmpty() and sum(counts) == len(rows)
    if shape in ("even", "gaps"):
        assert len(ranges) == 8 and max(counts) < 1.4 * len(rows) / 8 + 40
    if shape == "hot":
        assert sorted(counts)[-2] < 600


def test_ranges_need_an_order(frame):
    with pytest.raises(TypeError, match="string"):
        balanced_ranges(frame("k STRING", ("a",)), "k", 4)


def test_positions_go_through_all_ranges(spark):
    df = spark.range(5000).select((F.hash("id") % 700).alias("k"), "id")
    found = positions(df, [F.asc("k"), F.asc("id")], "place").collect()
    assert sorted(found, key=lambda r: r["place"]) == sorted(found, key=lambda r: (r["k"], r["id"]))
    assert sorted(r["place"] for r in found) == list(range(1, 5001))
    assert positions(df.limit(0), [F.asc("k")], "place").collect() == []


def test_first_rows_of_every_key_are_skipped(frame):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b", "c"]), k) for k in range(60)]
    rng.shuffle(rows)
    found = skip_first(frame("key STRING, n INT", *rows), ["key"], ["n"], 3)
    expected = [(key, n) for key, n in rows if sum(k == key and m < n for k, m in rows) >= 3]
    assert rows_of(found) == Counter(expected)
