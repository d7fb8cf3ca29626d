"""Choosing landed files by name, age and size, and reuse of stage tables.

Files are listed by Spark's ``binaryFile`` source; only path, time and length
are selected, so no content is read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators.lineage import removed


def listed_files(spark: SparkSession, folder: str, name_part: str = "", *, modified_after: datetime | None = None) -> DataFrame:
    """Files whose name contains ``name_part``: path, modified, length."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*{name_part}*")
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after.strftime("%Y-%m-%dT%H:%M:%S"))
    return reader.load(folder).select("path", F.col("modificationTime").alias("modified"), "length")


def fresh_files(
    spark: SparkSession, folder: str, name_part: str = "", *, as_of: datetime, hours: int = 12, min_bytes: int = 0
) -> DataFrame:
    """Files not older than ``hours`` at ``as_of`` (a time in the session's zone) and not too small."""
    listed = listed_files(spark, folder, name_part, modified_after=as_of - timedelta(hours=hours, seconds=1))
    not_older = F.col("modified") >= F.lit(as_of.isoformat(sep=" ")).cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS")
    return listed.where(not_older & (F.col("length") >= min_bytes))


def newest_file(files: DataFrame) -> str | None:
    """Path of the newest of the listed files (the last path wins a tie), or None."""
    newest = files.agg(F.max_by("path", F.struct("modified", "path")).alias("path"))
    return newest.first()["path"]


@dataclass(frozen=True)
class Newest:
    """The newest file of a folder whose name contains ``name_part``, to be given to a reader in place of a path.

    With ``as_of`` (a time in the session's zone) a file older than ``hours``
    is stale; one under ``min_bytes`` is an empty export.
    """

    folder: str
    name_part: str = ""
    as_of: datetime | None = None
    hours: int = 12
    min_bytes: int = 0


@dataclass(frozen=True)
class NewestPerUnit:
    """The newest file of every unit in a folder and its subfolders, to be given to a reader in place of a path.

    ``unit_pattern`` is a regular expression on a file's path behind the folder
    whose first group is the unit; files it does not match belong to none.  Of
    the ``units``, or of all that have a file, each must have a newest one that
    is neither stale nor too small (see `Newest`); else all that have not are
    named in one error.
    """

    folder: str
    unit_pattern: str
    name_part: str = ""
    units: frozenset[str] | None = None
    as_of: datetime | None = None
    hours: int = 12
    min_bytes: int = 0


def unit_of(path: Column, source: NewestPerUnit) -> Column:
    """The unit of a file by its path, null for none; escapes of a URL are resolved."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    folder = re.sub(r"^file:/*", "/", source.folder.rstrip("/"))
    behind = F.substring_index(plain, folder + "/", -1)
    return F.when(F.regexp_like(behind, F.lit(source.unit_pattern)), F.regexp_extract(behind, source.unit_pattern, 1))


def newest_per_unit(spark: SparkSession, source: NewestPerUnit) -> DataFrame:
    """``unit, path, modified, length`` of the newest file of each unit (the last path wins a tie), from names and times alone.

    Every task keeps one file per unit before the shuffle, so that a unit with
    years of exports costs no more than another.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{source.name_part}*")
    # The paths of a listing are plain: a percent sign in them is one.
    path = F.replace("path", F.lit("%"), F.lit("%25"))
    listed = reader.load(source.folder).select(unit_of(path, source).alias("unit"), "path", F.col("modificationTime").alias("modified"), "length")
    newest = F.max_by(F.struct("path", "modified", "length"), F.struct("modified", "path"))
    chosen = listed.where("unit IS NOT NULL").groupBy("unit").agg(newest.alias("newest")).select("unit", "newest.*")
    return chosen if source.units is None else chosen.where(F.col("unit").isin(sorted(source.units)))


def paths_per_unit(spark: SparkSession, source: NewestPerUnit) -> dict[str, str]:
    """The path of each unit's newest file, refused with the names of all units whose file is missing, stale or too small."""
    good = F.col("length") >= source.min_bytes
    if source.as_of is not None:
        oldest = F.lit(source.as_of.isoformat(sep=" ")).cast("timestamp") - F.expr(f"INTERVAL {source.hours} HOURS")
        good = good & (F.col("modified") >= oldest)
    rows = newest_per_unit(spark, source).select("unit", "path", good.alias("good")).collect()  # one row per unit
    found = {row["unit"]: row["path"] for row in rows}
    wrong = sorted({row["unit"] for row in rows if not row["good"]} | (set(source.units or ()) - set(found)))
    if wrong or not found:
        what = f"older than {source.hours} hours, smaller than {source.min_bytes} bytes or missing"
        raise ValueError(f"{source.folder}: the newest file is {what} for: {', '.join(wrong) or 'all units'}")
    return found


def _as_plain(path: str) -> str:
    """A path in which signs of a pattern stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def source_paths(spark: SparkSession, source: str | Sequence[str] | Newest | NewestPerUnit) -> str | Sequence[str]:
    """Paths as they are, or those of the newest files, refused when one is missing, stale or too small."""
    if isinstance(source, NewestPerUnit):
        return [_as_plain(path) for _, path in sorted(paths_per_unit(spark, source).items())]
    if not isinstance(source, Newest):
        return source
    path = newest_file(listed_files(spark, source.folder, source.name_part))
    if path is None:
        raise ValueError(f"{source.folder} has no file with {source.name_part!r} in its name")
    if source.as_of is None:
        good = listed_files(spark, source.folder, source.name_part).where(F.col("length") >= source.min_bytes)
    else:
        limits = {"as_of": source.as_of, "hours": source.hours, "min_bytes": source.min_bytes}
        good = fresh_files(spark, source.folder, source.name_part, **limits)
    if good.where(F.col("path") == path).isEmpty():
        raise ValueError(f"{path} is older than {source.hours} hours or smaller than {source.min_bytes} bytes")
    return _as_plain(path)


def staged(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], *, as_of: datetime, hours: int = 12
) -> DataFrame:
    """The parquet table at ``path`` if it was written within ``hours``, else built, written and read back."""
    if not _written_since(spark, path, as_of - timedelta(hours=hours)):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def files_digest(spark: SparkSession, paths: str | Sequence[str], *, name_part: str = "") -> str:
    """A digest of the path, time and length of all files, whatever the order they are listed in."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", f"*{name_part}*").load(paths)
    marks = [F.xxhash64("path", "modificationTime", "length", F.lit(seed)).cast("decimal(38,0)") for seed in (1, 2)]
    row = listed.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(mark), F.lit(0)).alias(f"sum{k}") for k, mark in enumerate(marks)]).first()
    return f"{row['n']:x}-{int(row['sum0']) % 2**64:016x}-{int(row['sum1']) % 2**64:016x}"


def staged_by_content(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], sources: str | Sequence[str], *, name_part: str = "", keep: int = 1
) -> DataFrame:
    """The stored table of the source files as they are now; built, written and read back if there is none.

    A stage lies in a folder named by the digest of its files, so a file that
    is replaced, added or removed builds a new one, and one left untouched is
    reused whatever its age.  A stage counts only when it was written to the
    end.  Of the earlier ones, ``keep`` less one stay, for runs that still read them.
    """
    digest = files_digest(spark, sources, name_part=name_part)
    folder = f"{path.rstrip('/')}/{digest}"
    if not exists(spark, f"{folder}/_SUCCESS"):
        build().write.mode("overwrite").parquet(folder)
        stages = [stage for stage in folders(spark, path) if stage[1] != digest]
        for _, name in sorted(stages, reverse=True)[max(0, keep - 1) :]:
            removed(spark, f"{path.rstrip('/')}/{name}")
    return spark.read.parquet(folder)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def folders(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Time and name of the folders directly in ``path``; none if there is no such path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    return [(status.getModificationTime(), status.getPath().getName()) for status in system.listStatus(place) if status.isDirectory()]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can list ``path``."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _written_since(spark: SparkSession, path: str, moment: datetime) -> bool:
    if not path_exists(spark, path):
        return False
    limit = F.lit(moment.isoformat(sep=" ")).cast("timestamp")
    parts = listed_files(spark, path, ".parquet").agg(F.min("modified").alias("oldest"))
    return bool(parts.select(F.coalesce(F.col("oldest") >= limit, F.lit(False))).first()[0])
