"""Helpers shared by the text operators."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Mapping
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators.lineage import cut_lineage

# A Python worker holds one batch at a time; both limits keep it small.
BATCH_ROWS = 500
BATCH_BYTES = 8 * 2**20


def prepared(spark: SparkSession) -> SparkSession:
    """The session with Arrow batches bounded in rows and bytes, and workers that find this package.

    Where executors do not share the package's folder, ship it with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    root = str(Path(__file__).resolve().parents[2])
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder, which
    is set on its context so that later calls find the same one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame, ``name`` for the reader, written as Parquet to the shared folder and read back.

    It survives lost executors, and tasks that are run again read the same
    rows.  Stages written inside `stages_removed` are deleted at its end; others
    stay, as frames that read them may be evaluated later.
    """
    shared_folder(df.sparkSession)
    return cut_lineage(df)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, in any case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rows_without(docs: DataFrame, dropped: DataFrame, keys: Mapping[str, Column], broadcast_rows: int) -> DataFrame:
    """The rows of ``docs`` whose keys are not in ``dropped``, null like any value, with their own columns only.

    ``keys`` gives for each column of ``dropped`` the expression on ``docs``.
    Up to ``broadcast_rows`` rows are broadcast; beyond it ``docs`` are shuffled.
    """
    names = {name: free_name(docs, f"dropped_{name}") for name in keys}
    gone = staged(dropped.select(*[F.col(name).alias(new) for name, new in names.items()]).distinct(), "dropped")
    if gone.count() <= broadcast_rows:
        gone = F.broadcast(gone)
    same = reduce(lambda done, more: done & more, [value.eqNullSafe(F.col(names[name])) for name, value in keys.items()])
    return docs.join(gone, same, "left_anti")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column and the offset of each text; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def texts(column: pa.Array) -> list[str]:
    """The texts of a column; null is empty."""
    return pc.fill_null(column, "").to_pylist()


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))
