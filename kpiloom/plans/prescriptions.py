"""Prescriptions against bookings of the prescription room."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions.dates import minute_label, parse_date
from kpiloom.functions.numbers import percent, share_percent
from kpiloom.functions.text import booking_name, department
from kpiloom.operators.aggregates import with_total
from kpiloom.operators.joins import rows_without
from kpiloom.operators.rows import computed_once, first_rows, holds

ISSUED_ON = "dd.MM.yyyy"


def first_bookings(bookings: DataFrame) -> DataFrame:
    """Bookings with normalised names, without summary lines, the first per person and day."""
    summary = F.col("subdivision").rlike("(?iu)" + "|".join(fv.SUMMARY_WORDS))
    body = bookings.where(~holds(summary)).withColumn("booked_date", F.col("booked_at").cast("date"))
    named = computed_once(body, "patient_name", booking_name(F.col("patient_name")))
    return first_rows(named, ["patient_name", "booked_date"], ["seq"])


def clean_bookings(bookings: DataFrame, *, as_of: date) -> tuple[DataFrame, DataFrame]:
    """Bookings that stand, and past bookings nobody came to.

    The first booking of a person and day counts whatever its mark.  No-shows
    before ``as_of`` are split off; missing, cancelled and moved bookings are
    dropped; later no-shows are still planned.
    """
    first = first_bookings(bookings)
    midnight = F.lit(as_of).cast("timestamp_ntz")
    past_no_show = holds((F.col("mark") == fv.MARK_NO_SHOW) & (F.col("booked_at") < midnight))
    standing = F.col("mark").isNotNull() & ~F.col("mark").isin(fv.MARK_CANCELLED, fv.MARK_MOVED)
    mark = F.when(F.col("mark") == fv.MARK_NO_SHOW, fv.MARK_PLANNED).otherwise(F.col("mark"))
    kept = first.where(~past_no_show & standing).withColumn("mark", mark)
    return kept, first.where(past_no_show)


def first_prescriptions(prescriptions: DataFrame) -> DataFrame:
    """The first prescription per person and day; the day is compared as written, then parsed."""
    upper = prescriptions.withColumn("patient_name", F.upper("patient_name"))
    return first_rows(upper, ["patient_name", "issue_date"], ["seq"]).withColumns(
        {
            "issue_date": parse_date(F.col("issue_date"), ISSUED_ON),
            "subdivision": department(F.col("department")),
        }
    )


def missing_booking(issued: DataFrame, kept: DataFrame, *, as_of: date) -> DataFrame:
    """Prescriptions from ``as_of`` on for people without any standing booking (no name is null here)."""
    return rows_without(issued.where(F.col("issue_date") >= F.lit(as_of)), kept, ["patient_name"], null_keys=False)


def noshow_fulfilled(noshow: DataFrame, issued: DataFrame) -> DataFrame:
    """No-shows that were given a prescription on the same day."""
    came = issued.select(
        "patient_name",
        F.col("issue_date").alias("booked_date"),
        "series_number",
        "doctor_name",
        "category_code",
        "address",
        "drug",
        "quantity",
        F.col("subdivision").alias("issuing_subdivision"),
    )
    missed = noshow.select(
        F.col("subdivision").alias("booking_subdivision"),
        "room",
        "patient_name",
        minute_label(F.col("booked_at")).alias("booked_at"),
        "booked_date",
    )
    return missed.join(came, ["patient_name", "booked_date"]).drop("booked_date")


def compliance(issued: DataFrame, kept: DataFrame, *, as_of: date) -> DataFrame:
    """Prescriptions before ``as_of`` per department and how many had a booking that day.

    Both sides hold one row per person and day, so no key can multiply rows.
    """
    before = issued.where(F.col("issue_date") < F.lit(as_of)).select(
        "patient_name", F.col("issue_date").alias("booked_date"), "department"
    )
    booked = kept.select("patient_name", "booked_date", "booked_at")
    return (
        before.join(booked, ["patient_name", "booked_date"], "left")
        .where(F.col("department").isNotNull())
        .groupBy("department")
        .agg(
            F.count(F.lit(1)).alias("prescriptions"),
            F.count_if(F.col("booked_at").isNotNull()).alias("by_rule"),
        )
        .withColumn("by_rule_pct", percent(F.col("by_rule"), F.col("prescriptions")).cast("long"))
    )


def compliance_rollup(by_department: DataFrame, total_label: str) -> DataFrame:
    """Rates per subdivision and in all, from the summed counts."""
    by_subdivision = (
        by_department.groupBy(department(F.col("department")).alias("subdivision"))
        .agg(F.sum("prescriptions").alias("prescriptions"), F.sum("by_rule").alias("by_rule"))
    )
    summed = with_total(by_subdivision, "subdivision", ["prescriptions", "by_rule"], total_label)
    rate = share_percent(F.col("by_rule"), F.col("prescriptions")).cast("long")
    return summed.select("subdivision", "prescriptions", "by_rule", rate.alias("rate_pct"))
