"""Writing report tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.sinks.versions import append_once, publish, published

PUBLISH_WEEKDAY = 3  # Thursday


def write_csv(df: DataFrame, path: str) -> None:
    """Replace a CSV table with header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Replace a published table as a whole; until the new rows are complete, readers see the old ones (`published_table`)."""
    publish(df, path)


def published_table(spark: SparkSession, path: str) -> DataFrame:
    """A table as `replace_table` last published it."""
    return published(spark, path)


def write_by_unit(df: DataFrame, path: str, unit: str, *, order: Sequence[str] = (), fmt: str = "csv") -> None:
    """One folder per unit, its rows in one order over all its files.

    Rows are dealt to tasks by ranges of unit and order, with bounds from a
    sample: small units share a task, and the parts of a unit larger than a
    task's share follow each other by file name.  Rows equal in both are told
    apart by a hash, so that a very frequent value is dealt to several tasks too.
    """
    columns = [F.col(name).asc_nulls_last() for name in order]
    told_apart = F.xxhash64(*[F.col(name) for name in df.columns])
    df = df.repartitionByRange(F.col(unit), *columns, told_apart).sortWithinPartitions(unit, *columns, told_apart)
    df.write.mode("overwrite").partitionBy(unit).option("header", True).format(fmt).save(path)


def replace_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace only the partitions that occur in ``df``; the others stay."""
    writer = df.hint("rebalance", partition).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def is_publish_day(as_of: date) -> bool:
    """The weekly table is extended on one weekday only."""
    return as_of.weekday() == PUBLISH_WEEKDAY


def stored_history(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The published history, empty before the first publication."""
    return published(spark, path, schema)


def append_history(new: DataFrame, path: str, schema: str, keys: Sequence[str], *, as_of: date) -> bool:
    """Add periods that are not stored yet; stored ones are never touched.

    Returns whether ``as_of`` is a publishing day.  A second run on the same
    day, one at the same time, or one after a crash adds nothing twice.
    """
    if not is_publish_day(as_of):
        return False
    append_once(new, path, schema, keys)
    return True
