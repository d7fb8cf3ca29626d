"""Figures kept from run to run: only what changed since the last run is computed again.

Two kinds: counts per day, of which a day is counted again when the digest of
its rows or files differs from the stored one; and the latest row per person,
which new rows can only replace by later ones, so that only persons whose stored
row was corrected or deleted are looked up again.
Both are stored by `sinks.versions`, so a broken run leaves the last figures.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators.joins import null_safe_join
from kpiloom.operators.lineage import cut_lineage

# Days that a filter on the source names one by one; more are looked up by a join.
LISTED_DAYS = 2000


def _digest(values: Sequence[Column | str]) -> list[Column]:
    """Count and two sums of hashes: equal for equal rows in any order, and repeated rows count."""
    hashes = [F.xxhash64(*values, F.lit(seed)).cast("decimal(38,0)") for seed in (1, 2)]
    return [F.count(F.lit(1)), *[F.sum(value) for value in hashes]]


def row_digests(df: DataFrame, day: str) -> DataFrame:
    """``day, digest`` of the rows of each day; rows without a day are a day of their own.

    Reads all rows, but combines them in each task and shuffles one row per day and task.
    """
    count, *sums = _digest([F.col(name) for name in sorted(df.columns)])
    found = df.groupBy(F.col(day).alias("day")).agg(count.alias("n"), *[value.alias(f"s{k}") for k, value in enumerate(sums)])
    return found.select("day", F.concat_ws("-", "n", *[f"s{k}" for k in range(len(sums))]).alias("digest"))


def file_digests(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """The same for a table with a folder per day, from the paths, times and lengths of its files; no row is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    of_day = F.regexp_extract(F.col("path"), rf"/{partition}=([^/]+)/", 1)
    day = F.when(of_day != "__HIVE_DEFAULT_PARTITION__", of_day.cast("date"))
    count, *sums = _digest(["path", "modificationTime", "length"])
    found = listed.groupBy(day.alias("day")).agg(count.alias("n"), *[value.alias(f"s{k}") for k, value in enumerate(sums)])
    return found.select("day", F.concat_ws("-", "n", *[f"s{k}" for k in range(len(sums))]).alias("digest"))


def changed_days(digests: DataFrame, stored: DataFrame) -> DataFrame:
    """``day, digest`` of days that are new or whose digest is not the stored one."""
    known = stored.select("day", "digest").distinct()
    return null_safe_join(digests, known, ["day", "digest"], "left_anti")


def only_days(df: DataFrame, day: str, days: DataFrame) -> DataFrame:
    """Rows of the given days; a plain list reaches the scan, so that files and folders of other days are skipped."""
    named = [row["day"] for row in days.select("day").limit(LISTED_DAYS + 1).collect()]
    if len(named) > LISTED_DAYS:
        return null_safe_join(df, days.select(F.col("day").alias(day)), [day], "left_semi")
    listed = F.col(day).isin([value for value in named if value is not None])
    return df.where(listed | F.col(day).isNull() if None in named else listed)


def refreshed_days(
    df: DataFrame, day: str, digests: DataFrame, stored: DataFrame, count: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Figures per day, with ``digest``: as stored for unchanged days, from ``count`` of their rows for the others.

    ``stored`` is a former result, or empty with its columns.  ``count`` returns
    rows with the column ``day`` and must treat days apart.  A day without any
    figure has one row of nulls, so that it is known to have been counted;
    days that are no longer there are dropped.
    """
    digests = cut_lineage(digests)
    changed = cut_lineage(changed_days(digests, stored))
    kept = null_safe_join(stored, digests, ["day", "digest"], "left_semi")
    if changed.isEmpty():
        return kept
    counted = count(only_days(df, day, changed)).withColumnRenamed(day, "day")
    fresh = null_safe_join(changed, counted, ["day"], "left")
    return kept.unionByName(fresh.select(*stored.columns))


def refreshed_latest(
    stored: DataFrame,
    rows: DataFrame,
    added: DataFrame,
    gone: DataFrame,
    *,
    person: Sequence[str],
    key: str,
    latest: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The latest row per person, from the stored ones and what changed since.

    ``added`` are new rows and corrected ones as they are now, ``gone`` the
    ``key`` of deleted rows and of corrected ones; ``key`` names a row.
    ``latest`` picks one row per person.  Only persons whose stored row is gone
    are looked up among all ``rows``, which are not read if there are none.
    """
    gone = gone.select(key).distinct()
    touched = cut_lineage(null_safe_join(stored, gone, [key], "left_semi").select(*person).distinct())
    merged = stored.unionByName(added.select(*stored.columns))
    if touched.isEmpty():
        return latest(merged)
    others = null_safe_join(merged, touched, list(person), "left_anti")
    again = null_safe_join(rows.select(*stored.columns), touched, list(person), "left_semi")
    return latest(others).unionByName(latest(again))
