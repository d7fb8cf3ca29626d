"""Published tables that survive a crash and two writers at once.

A run writes its rows to a folder of its own.  They are published by a numbered
manifest, which names the folders that make up the table; it is written aside
and put in place by one step that fails if the number is taken.  Readers take
the manifest with the highest number, so they see the table before or after a
run, never in between, and what a broken run leaves is never read.

The step is atomic on a file system whose rename is (HDFS, or a local one by a
hard link).  On an object store without such a rename, give each table one writer.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from kpiloom.operators.history import new_periods
from kpiloom.operators.lineage import removed
from kpiloom.operators.rows import conform
from kpiloom.sources.files import folders

# Manifests that stay, with their rows: the current one and those that readers may have begun with.
KEPT = 2
# Of a table that only grows, manifests are all that an earlier one costs.
KEPT_OF_APPENDED = 50


def _places(path: str) -> tuple[str, str]:
    path = path.rstrip("/")
    return f"{path}/rows", f"{path}/manifests"


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def manifests(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published manifests, lowest first."""
    place, system = _system(spark, _places(path)[1])
    if not system.exists(place):
        return []
    names = [status.getPath().getName() for status in system.listStatus(place)]
    return sorted(int(name) for name in names if name.isdigit())


def _named(spark: SparkSession, path: str, number: int) -> list[str]:
    """The row folders that a manifest names."""
    lines = spark.read.text(f"{_places(path)[1]}/{number:012d}").collect()  # one line per run that is part of the table
    return [row["value"] for row in lines if row["value"]]


def _put(spark: SparkSession, path: str, number: int, names: Sequence[str]) -> bool:
    """Publishes a manifest; False, and nothing changed, if another run has taken its number."""
    folder = _places(path)[1]
    place, system = _system(spark, f"{folder}/.{uuid.uuid4().hex}")
    out = system.create(place, False)
    try:
        out.write("".join(f"{name}\n" for name in names).encode())
    finally:
        out.close()
    target, _ = _system(spark, f"{folder}/{number:012d}")
    try:
        if system.getScheme() == "file":
            os.link(place.toUri().getPath(), target.toUri().getPath())
        else:
            files = spark._jvm.org.apache.hadoop.fs
            context = files.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
            context.rename(place, target, spark.sparkContext._gateway.new_array(files.Options.Rename, 0))
    except FileExistsError:
        return False
    except Py4JJavaError as problem:
        if "FileAlreadyExists" in str(problem.java_exception):
            return False
        raise
    finally:
        system.delete(place, False)
    return True


def _written(df: DataFrame, path: str) -> str:
    name = uuid.uuid4().hex
    df.write.parquet(f"{_places(path)[0]}/{name}")
    return name


def published(spark: SparkSession, path: str, schema: str | None = None, *, number: int | None = None) -> DataFrame:
    """The table as last published, or as of a manifest; empty before the first publication if its schema is given."""
    known = manifests(spark, path)
    if not known and schema is not None:
        return spark.createDataFrame([], schema)
    if not known or (number is not None and number not in known):
        raise ValueError(f"nothing is published at {path}" + (f" as number {number}" if number is not None else ""))
    names = _named(spark, path, known[-1] if number is None else number)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*[f"{_places(path)[0]}/{name}" for name in names])


def publish(df: DataFrame, path: str, *, kept: int = KEPT) -> int:
    """Replaces the table as a whole; the number of its manifest.

    Of two runs at once, the one that publishes last is seen.  Earlier
    manifests but for the last ``kept``, and rows that only they name, are removed.
    """
    spark = df.sparkSession
    name = _written(df, path)
    number = (manifests(spark, path) or [0])[-1] + 1
    while not _put(spark, path, number, [name]):
        number += 1
    _tidy(spark, path, kept)
    return number


def append_once(new: DataFrame, path: str, schema: str, keys: Sequence[str], *, kept: int = KEPT_OF_APPENDED) -> int:
    """Adds the rows whose keys are not in the table yet; the number of the manifest that holds them.

    A key that is there stays as it is.  A run that finds its number taken by
    another looks again at what is there by then, so that a key is added once,
    however often and however many runs add it.
    """
    spark = new.sparkSession
    while True:
        number = (manifests(spark, path) or [0])[-1]
        there = published(spark, path, schema, number=number or None)
        rows = new_periods(conform(new, schema), there, keys)
        name = _written(rows, path)
        added = spark.read.schema(schema).parquet(f"{_places(path)[0]}/{name}")
        if number and added.isEmpty():
            removed(spark, f"{_places(path)[0]}/{name}")
            return number
        if _put(spark, path, number + 1, [*(_named(spark, path, number) if number else []), name]):
            _tidy(spark, path, kept)
            return number + 1
        removed(spark, f"{_places(path)[0]}/{name}")


def _tidy(spark: SparkSession, path: str, kept: int) -> None:
    """Removes manifests but for the last ``kept``, and the rows that only they name."""
    known = manifests(spark, path)
    old, current = known[:-kept], known[-kept:]
    if not old:
        return
    needed = {name for number in current for name in _named(spark, path, number)}
    for number in old:
        gone = [name for name in _named(spark, path, number) if name not in needed]
        removed(spark, f"{_places(path)[1]}/{number:012d}")
        for name in gone:
            removed(spark, f"{_places(path)[0]}/{name}")


def remove_leftovers(spark: SparkSession, path: str, *, before_ms: int) -> list[str]:
    """Removes rows of broken runs: folders no manifest names, last changed before a time in milliseconds."""
    needed = {name for number in manifests(spark, path) for name in _named(spark, path, number)}
    stale = sorted(name for changed, name in folders(spark, _places(path)[0]) if name not in needed and changed < before_ms)
    for name in stale:
        removed(spark, f"{_places(path)[0]}/{name}")
    return stale
