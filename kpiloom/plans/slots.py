"""Schedule of doctors and equipment: gaps, nearest free cells, open minutes.

Cells are grouped by resource first and combine in each task, whatever the size
of a resource.  Names may already be columns of the cells, or be looked up for
the one row per resource that is left (`kpiloom.plans.extracts.name_resources`),
which spares the joins on the cells themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions.dates import days_until, interval_minutes, moment_literal
from kpiloom.operators.calendar import date_masks, missing_dates
from kpiloom.operators.rows import any_of, differs, is_in

RESOURCE_COLUMNS = (
    "resource_type", "subdivision_name", "department_name", "doctor_full_name", "specialty_id", "specialty_name",
    "equipment_name", "equipment_type", "cabinet_number",
)
WAITS = {"wait_days": "ac_doctor", "self_booking_wait_days": "ac_internet"}


def _first_of(cells: DataFrame, columns: Sequence[str] | None, order: Column) -> Column:
    """The columns (default: the known ones the cells have) of the earliest row of a group, as a struct."""
    if columns is None:
        columns = [name for name in RESOURCE_COLUMNS if name in cells.columns]
    return F.min_by(F.struct(*columns), order).alias("first")


def date_gaps(
    cells: DataFrame, *, first: date, days: int = 22, columns: Sequence[str] | None = None, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Resources with dates of the horizon on which they have no cell at all.

    Columns of the resource's earliest cell, and the array ``missing``.
    """
    masks = date_masks(F.col("begin_time"), first, days)
    names = [f"_mask{number}" for number in range(len(masks))]
    earliest = _first_of(cells, columns, F.struct("begin_time", "end_time", *tie_break))
    by_resource = cells.groupBy("resource_id").agg(earliest, *[mask.alias(name) for mask, name in zip(masks, names)])
    missing = missing_dates([F.col(name) for name in names], first, days)
    return by_resource.select("resource_id", "first.*", missing.alias("missing")).where(F.size("missing") > 0)


def doctor_gaps(gaps: DataFrame) -> DataFrame:
    """Doctors among the resources of `date_gaps`, with the dates as one text."""
    days = F.transform("missing", lambda day: F.date_format(day, "yyyy-MM-dd"))
    return gaps.where(F.col("resource_type") == fv.RESOURCE_DOCTOR).select(
        "resource_id", "resource_type", "subdivision_name", "department_name", "doctor_full_name",
        F.array_join(days, ", ").alias("missing_dates"),
    )


def first_free_cells(
    cells: DataFrame,
    *,
    now: datetime,
    columns: Sequence[str] | None = None,
    waits: Mapping[str, str] = WAITS,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Per resource with a free cell: columns of its first one and days of waiting.

    ``waits`` maps an output column to the access flag a cell must have; 9999
    means no such cell.  One grouped pass serves all flags.
    """
    moment = moment_literal(now)
    order = F.struct("begin_time", "end_time", *tie_break)
    free = cells.where((F.col("is_used") == 0) & (F.col("end_time") > moment))
    ends = [F.min_by("end_time", F.when(F.col(flag) == 1, order)).alias(f"_end_{out}") for out, flag in waits.items()]
    nearest = free.groupBy("resource_id").agg(_first_of(cells, columns, order), *ends)
    days = [F.coalesce(days_until(F.col(f"_end_{out}"), moment), F.lit(fv.NO_SLOT)).alias(out) for out in waits]
    return nearest.select("resource_id", "first.*", *days)


def _doctors_waiting(found: DataFrame, days: int) -> DataFrame:
    too_long = any_of([F.col(name) > days for name in WAITS])
    return found.where((F.col("resource_type") == fv.RESOURCE_DOCTOR) & too_long).select(
        "resource_id", "subdivision_name", "department_name", "doctor_full_name", "specialty_name", *WAITS
    )


def general_practice_waits(
    found: DataFrame, *, specialties: Sequence[int] = fv.GENERAL_SPECIALTIES, threshold: int = 1
) -> DataFrame:
    """General practitioners with a wait over the threshold, from `first_free_cells`."""
    return _doctors_waiting(found.where(F.col("specialty_id").isin(list(specialties))), threshold)


def specialist_waits(
    found: DataFrame, *, general: Sequence[int] = fv.GENERAL_SPECIALTIES, threshold: int = 10
) -> DataFrame:
    """All other doctors, one without a specialty included."""
    return _doctors_waiting(found.where(~is_in(F.col("specialty_id"), general)), threshold)


def equipment_waits(found: DataFrame, *, types: Sequence[str] = fv.SCANNER_TYPES) -> DataFrame:
    """Scanners outside in-patient rooms; a scanner without a room is left out."""
    scanner = (F.col("resource_type") == fv.RESOURCE_EQUIPMENT) & F.col("equipment_type").isin(list(types))
    return found.where(scanner & ~F.col("cabinet_number").contains(fv.ROOM_INPATIENT)).select(
        "resource_id", "subdivision_name", "department_name", "equipment_name", "cabinet_number", "wait_days"
    )


def open_minutes(cells: DataFrame, *, day: date, closed_code: int = fv.ACCESS_NOT_OPEN) -> DataFrame:
    """Minutes of cells per resource strictly inside the day, cells of one access code left out."""
    begin = F.col("begin_time")
    inside = (begin > F.lit(day).cast("timestamp_ntz")) & (
        begin < F.lit(day + timedelta(days=1)).cast("timestamp_ntz")
    )
    length = F.sum(F.col("end_time") - begin)
    return (
        cells.where(inside & differs(F.col("access_code"), closed_code))
        .groupBy("resource_id")
        .agg(interval_minutes(length).alias("open_minutes"))
    )
