"""Store a frame that is read more than once."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_of_run: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("stages of the run", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return folder.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame written as Parquet to the shared folder and read back.

    It survives lost executors, and whatever reads it takes only the columns
    and rows it needs.  Inside `stages_removed` the files go at the end.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/kpiloom-stages/{uuid.uuid4().hex}"
    written = _of_run.get()
    if written is not None:
        written.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, folder: str) -> bool:
    """Deletes a stored folder; whether there was one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def stages_removed() -> Iterator[None]:
    """Deletes what `cut_lineage` wrote inside, also after an error; usable as a decorator of a job."""
    written: list[tuple[SparkSession, str]] = []
    token = _of_run.set(written)
    try:
        yield
    finally:
        _of_run.reset(token)
        for spark, name in written:
            removed(spark, name)
