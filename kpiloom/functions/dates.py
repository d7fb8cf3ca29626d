"""Periods, calendars, working days and time labels.

Functions taking a ``date`` run on the driver and return constants for a plan;
functions taking a ``Column`` build expressions.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv

_A_MONDAY = date(1970, 1, 5)


@dataclass(frozen=True)
class Period:
    """Reporting period and the week before it, all ends inclusive."""

    first: date
    last: date
    yesterday: date
    past_monday: date
    past_sunday: date
    year_start: date


def reporting_period(as_of: date) -> Period:
    """This week up to ``as_of``; on a Monday the whole week before as well."""
    monday = as_of - timedelta(days=as_of.weekday())
    past_monday = monday - timedelta(days=7)
    return Period(
        first=past_monday if as_of == monday else monday,
        last=as_of,
        yesterday=as_of - timedelta(days=1),
        past_monday=past_monday,
        past_sunday=monday - timedelta(days=1),
        year_start=date(as_of.year, 1, 1),
    )


def period_columns(as_of: Column) -> dict[str, Column]:
    """The same period as columns, for a frame with many ``as_of`` dates."""
    monday = F.date_sub(as_of, F.weekday(as_of))
    past_monday = F.date_sub(monday, 7)
    return {
        "first_date": F.when(F.weekday(as_of) == 0, past_monday).otherwise(monday),
        "last_date": as_of,
        "yesterday": F.date_sub(as_of, 1),
        "past_monday": past_monday,
        "past_sunday": F.date_sub(monday, 1),
        "year_start": F.trunc(as_of, "year").cast("date"),
    }


def workdays_between(start: date, end: date, holidays: Iterable[date] = ()) -> int:
    """Working days from ``start`` to ``end``, both included."""
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    return int(np.busday_count(start, end + timedelta(days=1), holidays=sorted(holidays)))


def _weekdays_before(day: Column) -> Column:
    offset = F.datediff(day, F.lit(_A_MONDAY))
    weeks = F.floor(offset / F.lit(7))
    return weeks * 5 + F.least(offset - weeks * 7, F.lit(5))


def workdays(start: Column, end: Column, holidays: Iterable[date] = ()) -> Column:
    """Working days from ``start`` to ``end``, both included, in closed form.

    The cost per row depends on the number of holidays, not on the span.  A start
    after the end fails the query; a null on either side gives null.
    """
    count = _weekdays_before(F.date_add(end, 1)) - _weekdays_before(start)
    days_off = sorted({day for day in holidays if day.weekday() < 5})
    if days_off:
        inside = F.filter(F.lit(days_off), lambda day: day.between(start, end))
        count = count - F.size(inside)
    wrong = F.raise_error(F.concat(F.lit("start "), start, F.lit(" is after end "), end))
    return F.when(start > end, wrong).otherwise(count).cast("long")


def calendar(spark: SparkSession, first: date, days: int, name: str = "day") -> DataFrame:
    """``days`` consecutive dates from ``first`` on."""
    return spark.range(days).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias(name))


def date_list(first: date, last: date) -> list[date]:
    """Dates from ``first`` to ``last``, both included."""
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def parse_timestamp(value: Column, pattern: str) -> Column:
    """Timestamp without time zone by pattern; null where the text does not fit."""
    return F.try_to_timestamp(value, F.lit(pattern)).cast("timestamp_ntz")


def parse_date(value: Column, pattern: str) -> Column:
    return parse_timestamp(value, pattern).cast("date")


def weekday_label(day: Column) -> Column:
    """Name of the weekday, Monday first."""
    return F.element_at(F.lit(list(fv.WEEKDAYS)), F.weekday(day) + 1)


def days_until(moment: Column, as_of: Column) -> Column:
    """Whole calendar days from the day of ``as_of`` to the day of ``moment``."""
    return F.datediff(moment.cast("date"), as_of.cast("date"))


def moment_literal(moment: datetime) -> Column:
    """A moment without time zone (a bare datetime literal would be read in the machine's zone)."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def interval_minutes(interval: Column) -> Column:
    """Minutes of a difference of two moments, or of a sum of such differences.

    Differences are exact, so sum them first and turn the sum into minutes.
    """
    part = {name: F.extract(F.lit(name), interval) for name in ("DAY", "HOUR", "MINUTE", "SECOND")}
    whole = (part["DAY"] * 24 + part["HOUR"]) * 60 + part["MINUTE"]
    micros = whole.cast("long") * 60_000_000 + (part["SECOND"] * 1_000_000).cast("long")
    return micros / F.lit(60_000_000)


def minutes_between(begin: Column, end: Column) -> Column:
    return interval_minutes(end - begin)


def minute_label(moment: Column) -> Column:
    """Timestamp to the minute; midnight is shown as outside the schedule."""
    text = F.date_format(moment, "yyyy-MM-dd HH:mm")
    return F.replace(text, F.lit(fv.MIDNIGHT), F.lit(fv.OUTSIDE_SCHEDULE))


def day_month(day: Column) -> Column:
    return F.date_format(day, "dd.MM")


def days_heading(start: Column, end: Column) -> Column:
    """`week_heading` of two columns."""
    return F.concat(day_month(start), F.lit("-"), day_month(end))


def week_heading(start: date, end: date) -> str:
    """Heading of a published week column."""
    return f"{start:%d.%m}-{end:%d.%m}"
