"""Running totals over keys of any size.

A window that sums a whole key in order puts the key's rows into one task.
Here rows are dealt to ordered buckets first; a window runs inside each bucket
only, and the buckets' own totals are summed the same way, bucket by bucket of
buckets, until few are left.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.operators.lineage import cut_lineage

# Buckets whose totals one window sums.
WIDTH = 4096


def before(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str,
    order: Sequence[Column | str],
    value: str,
    buckets: int,
    name: str,
    *,
    width: int = WIDTH,
) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of the same ``keys`` that come earlier.

    Rows come in order of ``bucket``, a number from 0 to ``buckets`` - 1, and
    inside a bucket of ``order``.  ``buckets`` decides how large a bucket is,
    and must grow with the rows.  Null keys are keys; null values count as 0.
    """
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(value).over(inside), F.lit(0))
    if buckets <= 1:
        return df.withColumn(name, within)
    total, ahead, wide = f"_{name}_total", f"_{name}_ahead", f"_{bucket}_wide"
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias(total))
    if buckets <= width:
        earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn(ahead, F.coalesce(F.sum(total).over(earlier), F.lit(0)))
    else:
        sums = sums.withColumn(wide, F.expr(f"`{bucket}` div {width}L"))
        sums = before(sums, keys, wide, [bucket], total, -(-buckets // width), ahead, width=width)
    theirs = {key: f"_{name}_{k}" for k, key in enumerate([*keys, bucket])}
    sums = sums.select(*[F.col(key).alias(other) for key, other in theirs.items()], ahead)
    same = reduce(lambda done, pair: done & pair, [F.col(key).eqNullSafe(F.col(other)) for key, other in theirs.items()])
    joined = df.withColumn(name, within).join(sums, same, "left")
    return joined.withColumn(name, F.col(name) + F.coalesce(ahead, F.lit(0))).drop(ahead, *theirs.values())


def positions(df: DataFrame, order: Sequence[Column], name: str, *, first: int = 1) -> DataFrame:
    """``df`` with each row's place in an order of all rows, from ``first``.

    Rows are sorted by ranges and stored; a row's place is its place in its
    range and the number of rows in the ranges before, so that no task sees all
    rows.  Rows equal in ``order`` come in any order.
    """
    numbered = cut_lineage(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    # The upper bits of the id are the range, the lower ones the place in it.
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit(2**33 - 1))
    counts = sorted((row[0], row[1]) for row in numbered.groupBy(part.alias("part")).count().collect())  # one row per range
    ahead, total = [], first
    for number, n in counts:
        ahead.append((number, total))
        total += n
    starts = df.sparkSession.createDataFrame(ahead, "_part LONG, _ahead LONG")
    joined = numbered.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return joined.withColumn(name, F.col("_ahead") + place).drop("_part", "_ahead", "_id")
