"""Extract views over the base tables: schedule cells, visits, check-up cards.

The fact table is filtered first and then meets one plain dimension after the
other.  Spark compares each dimension's own size with its broadcast limit, so
small ones are looked up without moving the fact table, and a large one costs
one shuffle on its key.  (Joining dimensions with each other first would make
Spark multiply their sizes and shuffle the fact table for a tiny result.)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions.numbers import access_flags
from kpiloom.functions.text import full_name
from kpiloom.operators.rows import first_rows

Tables = Mapping[str, DataFrame]


def _look_up(df: DataFrame, tables: Tables, dimension: str, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Columns of a dimension (new name: dimension's name) by its key, null without a match."""
    wanted = tables[dimension].select(key, *[F.col(theirs).alias(ours) for ours, theirs in columns.items()])
    return df.join(wanted, key, "left")


def _with_unit(df: DataFrame, tables: Tables) -> DataFrame:
    """Names of the department and its subdivision."""
    named = _look_up(
        df, tables, "departments", "department_id", {"department_name": "name", "subdivision_id": "subdivision_id"}
    )
    return _look_up(named, tables, "subdivisions", "subdivision_id", {"subdivision_name": "name"})


def _with_doctor(df: DataFrame, tables: Tables) -> DataFrame:
    name = full_name(F.col("last_name"), F.col("first_name"), F.col("middle_name"))
    doctors = tables["doctors"].select("doctor_id", name.alias("doctor_full_name"))
    return df.join(doctors, "doctor_id", "left")


def schedule_cells(tables: Tables, *, as_of: date) -> DataFrame:
    """Cells from ``as_of`` on with one column per access right, without any names."""
    cells = tables["cells"].where(F.col("date") >= F.lit(as_of)).drop("date")
    return cells.withColumns(access_flags(F.col("access_code")))


def _shown(tables: Tables) -> DataFrame:
    return tables["resources"].where(F.col("in_time") == 1).drop("in_time")


def only_shown(found: DataFrame, tables: Tables) -> DataFrame:
    """Rows of the resources that are shown in the schedule."""
    return found.join(_shown(tables).select("resource_id"), "resource_id", "left_semi")


def _with_resource(df: DataFrame, tables: Tables) -> DataFrame:
    """Names that depend on the resource; rows of resources not shown in the schedule are dropped.

    A row without a resource fails that condition too, so the join is an inner one.
    """
    named = df.join(_shown(tables), "resource_id")
    named = _look_up(named, tables, "resource_types", "resource_type_id", {"resource_type": "name"})
    named = _look_up(
        named, tables, "equipment", "equipment_id",
        {"equipment_name": "name", "equipment_type_id": "equipment_type_id"},
    )
    named = _look_up(named, tables, "equipment_types", "equipment_type_id", {"equipment_type": "name"})
    named = _look_up(named, tables, "rooms", "room_id", {"cabinet_number": "number"})
    known = tables["specialties"].select(
        F.col("specialty_id").alias("_specialty"), "specialty_id", F.col("name").alias("specialty_name")
    )
    named = named.withColumnRenamed("specialty_id", "_specialty").join(known, "_specialty", "left")
    return _with_unit(named, tables)


def name_resources(found: DataFrame, tables: Tables) -> DataFrame:
    """Names for a frame with one row per resource and the doctor of its first cell."""
    return _with_doctor(_with_resource(found, tables), tables)


def schedule_view(tables: Tables, *, as_of: date) -> DataFrame:
    """Every cell from ``as_of`` on of resources shown in the schedule, with all names."""
    named = name_resources(schedule_cells(tables, as_of=as_of), tables)
    return _look_up(named, tables, "busy_types", "busy_type_id", {"cell_type": "name"}).select(
        "resource_id", "begin_time", "end_time", "resource_type", "doctor_full_name", "equipment_name",
        "equipment_type", "cabinet_number", "cell_type", "access_code", "is_used", "is_out_schedule",
        "specialty_id", "specialty_name", "department_name", "subdivision_name", *fv.ACCESS_BITS,
    )


def patient_visits(tables: Tables, *, since: date, latest_only: bool = False) -> DataFrame:
    """Closed visits since a date, with the patient's name parts, without the unit.

    ``latest_only`` keeps the latest visit of each patient and looks up names
    for those alone, which is all that visit recency needs.
    """
    people = tables["patients"].select(
        "patient_id",
        F.col("card_number").alias("mkab_number"),
        F.upper("last_name").alias("last_name"),
        F.left("first_name", F.lit(1)).alias("first_name"),
        F.left("middle_name", F.lit(1)).alias("middle_name"),
        F.date_format("birth_date", "yyyy").alias("birth_year"),
    )
    closed = tables["visits"].where(
        (F.col("visited_at") >= F.lit(since).cast("timestamp_ntz")) & (F.col("is_closed") == 1)
    )
    if latest_only:
        order = [F.desc_nulls_last("visited_at"), F.desc("tap_number")]
        closed = first_rows(closed, ["patient_id"], order, null_keys=True)
    return closed.withColumn("tap_date", F.col("visited_at").cast("date")).join(people, "patient_id", "left")


def visits_view(tables: Tables, *, since: date) -> DataFrame:
    """Closed visits since a date, with the patient's name parts and the unit."""
    visits = patient_visits(tables, since=since)
    placed = _look_up(visits, tables, "resources", "resource_id", {"department_id": "department_id"})
    return _with_unit(placed, tables).select(
        "tap_number", "tap_date", "mkab_number", "last_name", "first_name", "middle_name", "birth_year",
        "department_name", "subdivision_name",
    )


def cards_view(
    tables: Tables, *, since: date, until: date, reason: str, card_types: Sequence[str]
) -> DataFrame:
    """Closed check-up cards of a reason and kinds; ids are compared without case.

    ``until`` stands for its midnight, which is included.
    """
    closed = F.col("date_close")
    cards = (
        tables["cards"]
        .where((closed >= F.lit(since).cast("timestamp_ntz")) & (closed <= F.lit(until).cast("timestamp_ntz")))
        .where(F.col("is_closed") == 1)
        .where(F.upper("close_reason_guid") == reason.upper())
        .where(F.upper("card_type_guid").isin([kind.upper() for kind in card_types]))
    )
    placed = _look_up(
        cards, tables, "resources", "resource_id", {"doctor_id": "doctor_id", "department_id": "department_id"}
    )
    return _with_doctor(_with_unit(placed, tables), tables).select(
        "date_open", "date_close", "card_number", "subdivision_name", "doctor_full_name"
    )
