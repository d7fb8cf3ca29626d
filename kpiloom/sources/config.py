"""Small configuration tables: weights, plans, labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def config_table(spark: SparkSession, rows: Mapping | Iterable[tuple], schema: str) -> DataFrame:
    """A frame of configuration rows (or of a mapping's items).

    It is built as a local relation, so Spark knows its exact size and decides
    on its own whether a join may broadcast it.
    """
    layout = T.StructType.fromDDL(schema)
    names = layout.fieldNames()
    items = list(rows.items() if isinstance(rows, Mapping) else rows)
    if not items:
        return spark.createDataFrame([], layout)
    table = pa.table({name: [row[place] for row in items] for place, name in enumerate(names)})
    return spark.createDataFrame(table, schema=layout)
