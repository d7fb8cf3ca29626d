"""Joins in which a null key matches a null key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str] | Mapping[str, str], how: str = "left"
) -> DataFrame:
    """Equi-join with ``<=>``; right key columns are dropped.

    ``<=>`` stays an equi-join for Spark: a small side is broadcast after Spark's
    own size check, otherwise both sides are sorted and merged and adaptive
    execution splits a partition that one hot key has filled.
    """
    pairs = dict(keys) if isinstance(keys, Mapping) else {key: key for key in keys}
    other = right.withColumnsRenamed({theirs: f"_right_{ours}" for ours, theirs in pairs.items()})
    condition = reduce(
        lambda done, item: done & item,
        [F.col(ours).eqNullSafe(F.col(f"_right_{ours}")) for ours in pairs],
    )
    return left.join(other, condition, how).drop(*[f"_right_{ours}" for ours in pairs])


def rows_without(left: DataFrame, right: DataFrame, keys: Sequence[str], *, null_keys: bool = True) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``.

    The right side is cut to its distinct keys first, so copies of a hot key are
    dropped in each task before the shuffle.  Where no key can be null, say so
    with ``null_keys`` off: a plain equi-join reuses that shuffle.
    """
    others = right.select(*keys).distinct()
    if null_keys:
        return null_safe_join(left, others, keys, "left_anti")
    return left.join(others, list(keys), "left_anti")


def tagged_union(frames: Mapping[str, DataFrame], column: str) -> DataFrame:
    """Frames of one layout under each other, with their tag as first column."""
    tagged = [frame.select(F.lit(tag).alias(column), "*") for tag, frame in frames.items()]
    return reduce(DataFrame.unionByName, tagged)
