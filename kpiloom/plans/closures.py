"""Closed check-ups by unit and weekday against the weekly plan."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions.dates import parse_date, weekday_label
from kpiloom.functions.numbers import share_percent
from kpiloom.functions.text import site_prefix
from kpiloom.operators.aggregates import row_total, with_total
from kpiloom.operators.rows import computed_once

CLOSED_AT = "dd.MM.yyyy HH:mm:ss"


def weekday_closures(
    report: DataFrame, plan: DataFrame, *, org_id: int, main_site: str, first: date, last: date
) -> DataFrame:
    """Closures per unit: a column per weekday (null where none), the total and the plan.

    ``plan`` (unit, plan) is matched by unit name.
    """
    closed = F.col("closed_on")
    wanted = (
        report.where((F.col("org_id") == org_id) & (F.col("close_reason") == fv.CLOSURE_DONE))
        .where(F.col("exam_type").isin(list(fv.CLOSURE_EXAMS)))
        .where(F.col("unit").isNotNull())
        .select("unit", "closed_at")
    )
    dated = computed_once(wanted, "closed_on", parse_date(F.col("closed_at"), CLOSED_AT))
    by_day = (
        dated.where(closed.between(F.lit(first), F.lit(last)))
        .select(site_prefix(F.col("unit"), main_site).alias("unit"), weekday_label(closed).alias("weekday"))
        .groupBy("unit")
        .pivot("weekday", list(fv.WEEKDAYS))
        .agg(F.count(F.lit(1)))
    )
    return by_day.withColumn("total", row_total(fv.WEEKDAYS)).join(plan, "unit", "left")


def closure_rates(closures: DataFrame, total_label: str) -> DataFrame:
    """Percent of the plan per unit and for all units together."""
    summed = with_total(closures.select("unit", "total", "plan"), "unit", ["total", "plan"], total_label)
    return summed.select("unit", share_percent(F.col("total"), F.col("plan")).cast("long").alias("plan_pct"))
