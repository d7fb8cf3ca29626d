"""Published periods never change; only new periods are added."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.operators.joins import rows_without


def new_periods(new: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key has not been published yet."""
    return rows_without(new, history, keys)


def freeze_history(new: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The stored rows as they are, plus the rows of periods not stored yet."""
    return history.unionByName(new_periods(new, history, keys))


def stored_periods(history: DataFrame, period: str) -> list:
    """All periods of a stored history, earliest first: one per week, so the list is short."""
    found = history.select(period).where(F.col(period).isNotNull()).distinct().orderBy(period)
    return [row[0] for row in found.collect()]


def wide_history(
    history: DataFrame, unit: str, period: str, values: Sequence[str], periods: Sequence
) -> DataFrame:
    """One row per unit, the listed periods side by side, latest first.

    A column is named after its period, and after the value too if there are several.
    """
    latest_first = sorted(periods, reverse=True)
    return history.groupBy(unit).pivot(period, latest_first).agg(*[F.max(value).alias(value) for value in values])
