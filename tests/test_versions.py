"""Published versions: broken runs, readers during a run, writers at once."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from kpiloom.sinks import versions

SCHEMA = "unit STRING, week INT, value INT"
KEYS = ["unit", "week"]


def rows_of(df):
    return sorted(tuple(row) for row in df.collect())


def test_a_table_is_replaced_in_one_step(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="nothing is published"):
        versions.published(spark, path)
    assert versions.publish(frame("a INT", (1,)), path) == 1
    begun = versions.published(spark, path)
    assert versions.publish(frame("a INT", (2,), (3,)), path) == 2
    assert rows_of(begun) == [(1,)] and rows_of(versions.published(spark, path)) == [(2,), (3,)]
    assert rows_of(versions.published(spark, path, number=1)) == [(1,)]
    assert versions.publish(versions.published(spark, path).withColumn("a", F.col("a") * 10), path) == 3
    assert rows_of(versions.published(spark, path)) == [(20,), (30,)]
    assert versions.manifests(spark, path) == [2, 3] and len(os.listdir(f"{path}/rows")) == 2


def test_a_failed_write_leaves_the_old_table(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    versions.publish(frame("a INT", (1,)), path)
    broken = spark.range(8).repartition(4).select(F.when(F.col("id") == 5, F.raise_error(F.lit("broken"))).otherwise(1).cast("int").alias("a"))
    with pytest.raises(Exception, match="broken"):
        versions.publish(broken, path)
    assert rows_of(versions.published(spark, path)) == [(1,)]
    # A run that ends between its rows and its manifest is not seen either, and cleared away later.
    left = versions._written(frame("a INT", (9,)), path)
    assert rows_of(versions.published(spark, path)) == [(1,)]
    assert versions.remove_leftovers(spark, path, before_ms=0) == []
    assert left in versions.remove_leftovers(spark, path, before_ms=int(time.time() * 1000) + 10_000)
    assert rows_of(versions.published(spark, path)) == [(1,)] and len(os.listdir(f"{path}/rows")) == 1


def test_a_number_is_taken_once(spark, tmp_path):
    path = str(tmp_path / "t")
    taken, wait = [], threading.Barrier(6)

    def put(k):
        wait.wait()
        if versions._put(spark, path, 1, [f"run{k}"]):
            taken.append(k)

    threads = [threading.Thread(target=put, args=(k,)) for k in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(taken) == 1 and versions._named(spark, path, 1) == [f"run{taken[0]}"]
    assert [name for name in os.listdir(f"{path}/manifests") if not name.startswith(".")] == ["000000000001"]


def test_a_week_is_added_once_also_by_runs_at_once(spark, frame, tmp_path):
    path = str(tmp_path / "h")
    assert rows_of(versions.published(spark, path, SCHEMA)) == []
    failed = []

    def add(k):
        try:
            week = frame(SCHEMA, ("A", 1, k), ("B", 1, k), (f"own{k}", 1, k), (None, 1, k))
            versions.append_once(week, path, SCHEMA, KEYS)
        except Exception as problem:
            failed.append(problem)

    threads = [threading.Thread(target=add, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed
    found = rows_of(versions.published(spark, path, SCHEMA).where("unit IS NOT NULL"))
    assert [row[0] for row in found] == ["A", "B", "own0", "own1", "own2", "own3"]
    assert versions.published(spark, path, SCHEMA).where("unit IS NULL").count() == 1
    before = versions.manifests(spark, path)
    versions.append_once(frame(SCHEMA, ("A", 1, 99), (None, 1, 99)), path, SCHEMA, KEYS)
    assert versions.manifests(spark, path) == before  # nothing new
    versions.append_once(frame(SCHEMA, ("A", 2, 5)), path, SCHEMA, KEYS)
    assert ("A", 2, 5) in rows_of(versions.published(spark, path, SCHEMA).where("unit = 'A'"))
