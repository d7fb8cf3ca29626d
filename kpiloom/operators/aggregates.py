"""Total rows, pivots over a fixed list, gap-filled daily counts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.dates import calendar
from kpiloom.operators.rows import present


def with_total(
    df: DataFrame, key: str, sums: Sequence[str], label: str, *, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per key plus a row of sums named ``label``.

    ``df`` holds one row per key already, so the rollup expands the short
    table, not the source.  Columns in ``keep`` stay as they are and are null in
    the total row; ratios are to be computed from the sums afterwards.  The
    label is set by grouping id, so a unit of that name is not mixed up with it.
    """
    total = F.grouping_id() == 1
    return df.rollup(key).agg(
        F.when(total, F.lit(label)).otherwise(F.col(key)).alias("_key"),
        *[F.sum(name).alias(name) for name in sums],
        *[F.when(~total, F.max(name)).alias(name) for name in keep],
        total.alias("is_total"),
    ).drop(key).withColumnRenamed("_key", key)


def counts_by(df: DataFrame, keys: Sequence[str], counted: str, name: str) -> DataFrame:
    """Non-null values of ``counted`` per key; rows with a null key are dropped."""
    return df.where(present(keys)).groupBy(*keys).agg(F.count(counted).alias(name))


def row_total(names: Sequence[str]) -> Column:
    """Sum over columns, nulls skipped."""
    return reduce(lambda left, right: left + right, [F.coalesce(F.col(name), F.lit(0)) for name in names])


def gap_filled(counts: DataFrame, day: str, value: str, first: date, days: int) -> DataFrame:
    """Daily values with a 0 for every calendar date that has none."""
    dates = calendar(counts.sparkSession, first, days, day)
    return dates.join(counts, day, "left").select(day, F.coalesce(value, F.lit(0)).alias(value))


def labelled_totals(totals: DataFrame, labels: dict[str, str]) -> DataFrame:
    """One row per column of a one-row frame: label, value."""
    pairs = [F.struct(F.lit(label).alias("label"), F.col(name).alias("value")) for name, label in labels.items()]
    return totals.select(F.inline(F.array(*pairs)))
