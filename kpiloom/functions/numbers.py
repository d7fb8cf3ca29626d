"""Rounding, shares and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv


def half_even(value: Column, digits: int = 0) -> Column:
    """Round half to even on the double value (``round`` in Spark rounds half up)."""
    if digits == 0:
        return F.rint(value)
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def percent(part: Column, whole: Column, digits: int = 0) -> Column:
    """``100 * part / whole`` rounded half to even; null when ``whole`` is 0."""
    return half_even(F.try_divide(F.lit(100) * part, whole), digits)


def share_percent(part: Column, whole: Column, digits: int = 0) -> Column:
    """``part / whole * 100``: divides first, which differs from `percent` at exact ties."""
    return half_even(F.try_divide(part, whole) * F.lit(100.0), digits)


def bit_flag(code: Column, bit: int) -> Column:
    """1 when ``bit`` is set in ``code``, else 0 (also for a null code)."""
    return F.when(code.bitwiseAND(F.lit(bit)) > 0, 1).otherwise(0)


def access_flags(code: Column) -> dict[str, Column]:
    """One 0/1 column per access right of a schedule cell."""
    return {name: bit_flag(code, bit) for name, bit in fv.ACCESS_BITS.items()}


def gap_score(gap: Column) -> Column:
    """Traffic-light points for the gap to plan, in percent points."""
    near, far = fv.GAP_LIMITS
    return F.when(gap < near, 5).when(gap < far, 3).when(gap >= far, 0)
