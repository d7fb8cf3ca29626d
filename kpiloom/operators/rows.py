"""Row-wise helpers: first row per key, column layout, null-aware filters, counts of bad rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.operators.joins import null_safe_join


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column whose expression runs once per row, also when later filters use it.

    A filter on an ordinary derived column is moved below it with a copy of the
    expression, so a costly one (text parsing) runs several times.  A generated
    column is not copied.
    """
    kept = [column for column in df.columns if column != name]
    # In its own projection first, where Spark shares the parts that repeat inside the expression.
    derived = df.select(*kept, value.alias("_derived"))
    return derived.select(*kept, F.explode(F.array("_derived")).alias(name))


def present(names: Sequence[str]) -> Column:
    """No column in ``names`` is null."""
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).isNotNull()
    return condition


def first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], *, null_keys: bool = False
) -> DataFrame:
    """The first row of each key in ``order``.

    Spark limits every key to one row per task before the shuffle, so a key that
    holds a third of the table costs no more than any other.  Rows with a null
    key are dropped, or kept as a key of their own with ``null_keys``.
    """
    source = df if null_keys else df.where(present(keys))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return source.withColumn("_place", place).where("_place = 1").drop("_place")


def skip_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Rows but for the first ``n`` of each key in ``order``, which names a row of a key.

    The first rows are found with a limit in each task, and only they are
    compared with all rows, so that a key of any length is no single task.
    Rows without a key are a key of their own.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    head = df.select(*keys, *order).withColumn("_place", place).where(F.col("_place") <= n).drop("_place")
    return null_safe_join(df, head, [*keys, *order], "left_anti")


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


def is_in(value: Column, items: Sequence) -> Column:
    """IN list that is false, never null, for a null value."""
    return F.coalesce(value.isin(list(items)), F.lit(False))


def holds(condition: Column) -> Column:
    """The condition with null taken as false, so that it can be negated."""
    return F.coalesce(condition, F.lit(False))


def differs(value: Column, other) -> Column:
    """Inequality that is true for a null value."""
    return ~value.eqNullSafe(other)


def keep_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Those of the listed columns that the frame has."""
    return df.select([name for name in names if name in df.columns])


def conform(df: DataFrame, schema: str, names: Mapping[str, str] | None = None) -> DataFrame:
    """Columns of ``schema`` picked by name (``names`` maps schema name to source name) and cast."""
    names = names or {}
    fields = T.StructType.fromDDL(schema).fields
    return df.select([F.col(names.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in fields])


def sorted_report(df: DataFrame, *names: str, descending: bool = False) -> DataFrame:
    """Display order with nulls last."""
    order = [F.col(name).desc_nulls_last() if descending else F.col(name).asc_nulls_last() for name in names]
    return df.orderBy(*order)


def quality(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row: rows in all, and rows failing each named check."""
    failures = [F.count_if(holds(failed)).alias(name) for name, failed in checks.items()]
    return df.agg(F.count(F.lit(1)).alias("rows"), *failures)
