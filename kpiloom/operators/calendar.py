"""Dates without any record, per entity."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_BITS = 62  # dates per bit mask; a long has 63 usable bits


def date_masks(moment: Column, first: date, days: int) -> list[Column]:
    """Aggregates that record which dates of the horizon occur, one bit per date.

    ``bit_or`` on a long keeps the aggregation buffer at 8 bytes per 62 dates
    however many records an entity has, and it combines in each task before the
    shuffle.
    """
    offset = F.datediff(moment.cast("date"), F.lit(first))
    masks = []
    for start in range(0, days, _BITS):
        inside = offset.between(start, min(start + _BITS, days) - 1)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), offset - start)
        masks.append(F.coalesce(F.bit_or(F.when(inside, bit)), F.lit(0).cast("long")))
    return masks


def _unset_dates(mask: Column, first: date, width: int) -> Column:
    offsets = F.filter(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda place: F.call_function("bit_get", mask, place) == 0,
    )
    return F.transform(offsets, lambda place: F.date_add(F.lit(first), place))


def missing_dates(masks: list[Column], first: date, days: int) -> Column:
    """Array of the horizon's dates that are not set in the masks, in order."""
    starts = range(0, days, _BITS)
    return F.concat(
        *[
            _unset_dates(mask, first + timedelta(days=start), min(_BITS, days - start))
            for mask, start in zip(masks, starts)
        ]
    )
