"""Reading the driver tables and deriving columns."""

from __future__ import annotations

import tempfile
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.operators.rows import computed_once


_LAYOUTS: dict[str, T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table; its layout is read from the file once per process."""
    path = f"{folder}/{name}.parquet"
    if path not in _LAYOUTS:
        _LAYOUTS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_LAYOUTS[path]).parquet(path)


def stage_folder(spark: SparkSession) -> None:
    """Gives a local session without ``spark.checkpoint.dir`` a folder for stored frames; a cluster names its own."""
    context = spark.sparkContext
    unset = spark.conf.get("spark.checkpoint.dir", None) is None and context.getCheckpointDir() is None
    if unset and context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="kpiloom-"))


def steps(value: Column, limits: Sequence[tuple], last=None) -> Column:
    """The option of the first limit above ``value``, else ``last``; an option may be None."""
    chain = None
    for limit, option in limits:
        chain = F.when(value < limit, F.lit(option)) if chain is None else chain.when(value < limit, F.lit(option))
    return chain.otherwise(F.lit(last))


def _literal(option) -> str:
    return "NULL" if option is None else str(option) if isinstance(option, int) else f"'{option}'"


def steps_sql(value: str, limits: Sequence[tuple], last=None) -> str:
    """The same as SQL text."""
    whens = " ".join(f"WHEN {value} < {limit} THEN {_literal(option)}" for limit, option in limits)
    return f"CASE {whens} ELSE {_literal(last)} END"


def labels(value: Column, options: Mapping, last=None) -> Column:
    """The option stored for ``value``, else ``last``."""
    chain = None
    for key, option in options.items():
        chain = F.when(value == key, F.lit(option)) if chain is None else chain.when(value == key, F.lit(option))
    return chain.otherwise(F.lit(last))


def labels_sql(value: str, options: Mapping, last=None) -> str:
    """The same as SQL text."""
    whens = " ".join(f"WHEN {_literal(key)} THEN {_literal(option)}" for key, option in options.items())
    return f"CASE {value} {whens} ELSE {_literal(last)} END"


def numbered_events(events: DataFrame) -> DataFrame:
    """Events with the number in their ``props``, 0 to 99, as column ``k``."""
    return computed_once(events, "k", F.get_json_object("props", "$.k").cast("int"))


EVENT_NUMBER_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
