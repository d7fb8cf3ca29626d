"""Calls to one line: counts by status and agent, the last days as a table."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions.dates import date_list
from kpiloom.functions.text import Rules, first_match
from kpiloom.operators.aggregates import counts_by, gap_filled, labelled_totals, with_total


def line_calls(calls: DataFrame, *, line: int, agents: Rules) -> DataFrame:
    """Calls of one line, with the agent's label (null for an unknown one) and the date parsed.

    The label is an ordinary column, so that reports that do not show it never compute it.
    """
    of_line = calls.where(F.col("incoming_line") == line)
    labelled = of_line.withColumn("agent", first_match(F.col("first_answerer"), agents))
    return labelled.withColumn("call_date", F.col("call_date").try_cast("date"))


def calls_by_status(calls: DataFrame) -> DataFrame:
    return counts_by(calls, ["status"], "type", "calls")


def calls_by_agent(calls: DataFrame) -> DataFrame:
    """Answered calls per known agent."""
    return counts_by(calls.where(F.col("status") == fv.CALL_ANSWERED), ["agent"], "type", "answered")


def _recent(calls: DataFrame, as_of: date, days: int) -> DataFrame:
    return calls.where(F.col("call_date").between(F.lit(as_of - timedelta(days=days)), F.lit(as_of)))


def answered_by_day(calls: DataFrame, *, as_of: date, days: int = 10, total_label: str = "TOTAL") -> DataFrame:
    """Answered calls per agent and date of the last days, 0 where none, with a total row."""
    dates = [day.isoformat() for day in date_list(as_of - timedelta(days=days), as_of)]
    answered = _recent(calls, as_of, days).where(
        (F.col("status") == fv.CALL_ANSWERED) & F.col("agent").isNotNull()
    )
    by_agent = (
        answered.withColumn("call_date", F.date_format("call_date", "yyyy-MM-dd"))
        .groupBy("agent")
        .pivot("call_date", dates)
        .agg(F.count("call_time"))
        .fillna(0)
    )
    return with_total(by_agent, "agent", dates, total_label).drop("is_total").select("agent", *dates)


def missed_by_day(calls: DataFrame, *, as_of: date, days: int = 10) -> DataFrame:
    """Missed calls per date of the last days, 0 where none."""
    missed = _recent(calls, as_of, days).where(F.col("status") == fv.CALL_MISSED)
    counts = counts_by(missed, ["call_date"], "call_time", "missed")
    return gap_filled(counts, "call_date", "missed", as_of - timedelta(days=days), days + 1)


def call_board(
    calls: DataFrame, *, as_of: date, days: int = 10, total_label: str = "TOTAL", missed_label: str = "MISSED"
) -> DataFrame:
    """The answered table with a row of missed calls under it, over one calendar and in one pass."""
    dates = [day.isoformat() for day in date_list(as_of - timedelta(days=days), as_of)]
    answered = (F.col("status") == fv.CALL_ANSWERED) & F.col("agent").isNotNull()
    missed = F.col("status") == fv.CALL_MISSED
    counted = (
        _recent(calls, as_of, days)
        .where(answered | missed)
        .select(
            missed.alias("is_missed"),
            F.when(missed, missed_label).otherwise(F.col("agent")).alias("agent"),
            F.date_format("call_date", "yyyy-MM-dd").alias("call_date"),
            "call_time",
        )
        .groupBy("is_missed", "agent")
        .pivot("call_date", dates)
        .agg(F.count("call_time"))
        .fillna(0)
    )
    no_misses = calls.sparkSession.range(1).select(
        F.lit(True).alias("is_missed"), F.lit(missed_label).alias("agent"), *[F.lit(0).cast("long").alias(d) for d in dates]
    )
    level = F.grouping_id()  # 0: one agent or the missed calls, 1: subtotal of either kind
    board = (
        counted.unionByName(no_misses)
        .rollup("is_missed", "agent")
        .agg(
            F.when(level == 0, F.col("agent")).otherwise(total_label).alias("label"),
            *[F.sum(F.col(day)).alias(day) for day in dates],
            level.alias("level"),
        )
        .where((F.col("level") == 0) | ((F.col("level") == 1) & ~F.col("is_missed")))
    )
    return board.select(F.col("label").alias("agent"), *dates)


def recent_totals(calls: DataFrame, *, as_of: date, days: int = 10) -> DataFrame:
    """Two labelled numbers: answered and missed calls of the last days."""
    totals = _recent(calls, as_of, days).agg(
        F.count_if(F.col("status") == fv.CALL_ANSWERED).alias("answered"),
        F.count_if(F.col("status") == fv.CALL_MISSED).alias("missed"),
    )
    return labelled_totals(totals, {"answered": "answered", "missed": "missed"})
