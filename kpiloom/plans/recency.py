"""Last visit of followed-up patients."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions.text import department
from kpiloom.operators.joins import null_safe_join
from kpiloom.operators.rows import first_rows

PERSON = ("last_name", "first_name", "middle_name", "birth_year")


def latest_visits(visits: DataFrame) -> DataFrame:
    """The latest visit per person; a missing name part is a value of its own.

    Visits of one day are ordered by ``visited_at`` where the frame has it.
    """
    numbered = visits.withColumn("birth_year", F.col("birth_year").try_cast("int"))
    latest = [name for name in ("tap_date", "visited_at") if name in visits.columns]
    order = [*[F.desc_nulls_last(name) for name in latest], F.desc("tap_number")]
    return first_rows(numbered, PERSON, order, null_keys=True)


def recency_band(day: Column, as_of: date) -> Column:
    """Colour word by days since ``day``; empty for a recent or a missing one."""
    age = F.datediff(F.lit(as_of), day)
    return F.when(age >= fv.BAND_RED_DAYS, "red").when(age >= fv.BAND_YELLOW_DAYS, "yellow").otherwise("")


def recency(patients: DataFrame, visits: DataFrame, *, org_id: int, as_of: date) -> DataFrame:
    """Patients of one organisation with their latest visit and its band."""
    followed = patients.where(F.col("org_id") == org_id).select(
        department(F.col("unit")).alias("subdivision"),
        F.col("unit").alias("department"),
        *[name for name in PERSON if name != "birth_year"],
        F.col("birth_year").try_cast("int").alias("birth_year"),
        "age",
    )
    latest = latest_visits(visits).select(*PERSON, "mkab_number", "tap_date")
    return null_safe_join(followed, latest, PERSON).select(
        "subdivision",
        "department",
        "mkab_number",
        *PERSON,
        "age",
        "tap_date",
        recency_band(F.col("tap_date"), as_of).alias("band"),
    )
