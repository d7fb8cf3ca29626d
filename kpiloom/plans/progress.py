"""Check-up plan monitoring: plan against fact by unit, cumulative and for a week."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.dates import week_heading, workdays_between
from kpiloom.functions.numbers import percent
from kpiloom.operators.aggregates import with_total
from kpiloom.operators.history import wide_history
from kpiloom.operators.rows import is_in, present


@dataclass(frozen=True)
class Plan:
    """Annual plan, working days it is spread over, days off, and the label of the total row."""

    annual: int
    year_days: int
    holidays: tuple[date, ...] = ()
    total_label: str = "TOTAL"

    def due(self, start: date, end: date) -> int:
        """Whole plan due over the working days of a span, for all units together."""
        return self.annual // self.year_days * workdays_between(start, end, self.holidays)


@dataclass(frozen=True)
class Span:
    """Dates that are counted (both ends included, an open start) and the plan due for them."""

    end: date
    due: int
    start: date | None = None

    def covers(self, day: Column) -> Column:
        inside = day <= F.lit(self.end)
        return inside if self.start is None else inside & (day >= F.lit(self.start))


def in_scope(cards: DataFrame, allowed: Sequence[str], unit: str = "unit") -> DataFrame:
    return cards.where(F.col(unit).isin(list(allowed)))


def out_of_scope(cards: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Cards of units outside the list, a missing unit included."""
    return cards.where(~is_in(F.col("unit"), allowed)).select(
        "unit", "doctor_name", "card_number", F.date_format("date_close", "yyyy-MM-dd").alias("date_close")
    )


def daily_counts(cards: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cards per key and day: a short table that serves every report of a run in place of the cards."""
    return cards.groupBy(*keys, "date_close").agg(
        F.count("card_number").alias("cards"), F.count(F.lit(1)).alias("rows")
    )


def period_counts(cards: DataFrame, keys: Sequence[str], spans: Mapping[str, Span]) -> DataFrame:
    """Cards per key for several spans in one pass, from cards or from `daily_counts`.

    For each span: ``n_<name>`` counts cards, ``rows_<name>`` tells whether the
    key has any row in the span at all.
    """
    by_day = "cards" in cards.columns
    card = F.col("cards") if by_day else F.col("card_number").isNotNull().cast("long")
    row = F.col("rows") if by_day else F.lit(1).cast("long")
    day = F.col("date_close")
    last = max(span.end for span in spans.values())
    starts = [span.start for span in spans.values()]
    wanted = cards.where(day <= F.lit(last)).where(present(keys))
    if all(start is not None for start in starts):
        wanted = wanted.where(day >= F.lit(min(starts)))
    measures = []
    for name, span in spans.items():
        inside = span.covers(day)
        measures.append(F.sum(F.when(inside, card).otherwise(0)).alias(f"n_{name}"))
        measures.append(F.sum(F.when(inside, row).otherwise(0)).alias(f"rows_{name}"))
    return wanted.groupBy(*keys).agg(*measures)


def _plan_columns(name: str, due: int) -> dict[str, Column]:
    # The efficiency of a row is measured against the target before it is cut to a whole number.
    exact = F.lit(due) * F.col("weight")
    done = F.col(f"n_{name}")
    return {
        f"target_{name}": exact.cast("long"),
        f"efficiency_{name}": percent(done, exact, 2),
    }


def _total_efficiency(name: str) -> Column:
    # The total row is measured against the sum of the cut targets.
    of_sums = percent(F.col(f"n_{name}"), F.col(f"target_{name}"), 2)
    return F.when(F.col("is_total"), of_sums).otherwise(F.col(f"efficiency_{name}"))


def plan_progress(
    cards: DataFrame, weights: DataFrame, plan: Plan, span: Span, *, annual: bool = True
) -> DataFrame:
    """Plan, target, fact and efficiency per unit with a total row.

    ``weights`` (unit, weight) sets the units in scope.
    """
    counted = period_counts(cards, ["unit"], {"span": span}).join(weights, "unit")
    rows = counted.withColumns(
        {"annual_plan": (F.lit(plan.annual) * F.col("weight")).cast("long"), **_plan_columns("span", span.due)}
    )
    total = with_total(
        rows, "unit", ["annual_plan", "target_span", "n_span"], plan.total_label, keep=["efficiency_span"]
    )
    yearly = ["annual_plan"] if annual else []
    return total.select(
        "unit",
        *yearly,
        F.col("target_span").alias("target"),
        F.col("n_span").alias("done"),
        _total_efficiency("span").alias("efficiency"),
    )


def plan_progress_combined(
    cards: DataFrame, weights: DataFrame, plan: Plan, cumulative: Span, week: Span
) -> DataFrame:
    """Cumulative and weekly progress side by side, from one pass over the cards.

    A unit without any row in the week has null weekly figures, which do not
    enter the weekly total.
    """
    spans = {"year": cumulative, "week": week}
    counted = period_counts(cards, ["unit"], spans).where("rows_year > 0").join(weights, "unit")
    rows = counted.withColumns(
        {
            "annual_plan": (F.lit(plan.annual) * F.col("weight")).cast("long"),
            **_plan_columns("year", cumulative.due),
            **_plan_columns("week", week.due),
        }
    )
    weekly = ["target_week", "n_week", "efficiency_week"]
    rows = rows.withColumns({name: F.when(F.col("rows_week") > 0, F.col(name)) for name in weekly})
    total = with_total(
        rows,
        "unit",
        ["annual_plan", "target_year", "n_year", "target_week", "n_week"],
        plan.total_label,
        keep=["efficiency_year", "efficiency_week"],
    )
    return total.select(
        "unit",
        "annual_plan",
        F.col("target_year").alias("target"),
        F.col("n_year").alias("done"),
        _total_efficiency("year").alias("efficiency"),
        "target_week",
        F.col("n_week").alias("done_week"),
        _total_efficiency("week").alias("efficiency_week"),
    )


def week_history(week: DataFrame, start: date, end: date) -> DataFrame:
    """The rows of a weekly table in the layout of the stored history."""
    return week.select(
        "unit",
        F.lit(start).alias("period_start"),
        F.lit(end).alias("period_end"),
        "target",
        F.col("done").alias("fact"),
        "efficiency",
    )


def published_progress(cumulative: DataFrame, history: DataFrame, weeks: Sequence[date]) -> DataFrame:
    """The cumulative table with the stored weeks beside it, latest week first."""
    wide = wide_history(history, "unit", "period_start", ["target", "fact", "efficiency"], weeks)
    return cumulative.join(wide, "unit", "left")


def with_week_headings(published: DataFrame, weeks: Sequence[date]) -> DataFrame:
    """`published_progress` with its weekly columns headed by the days of the week; a heading used by a later week gets the year."""
    names: dict[str, str] = {}
    for week in sorted(weeks, reverse=True):
        heading = week_heading(week, week + timedelta(days=6))
        if any(name.startswith(heading + " ") for name in names.values()):
            heading = f"{heading} {week.year}"
        names.update({f"{week}_{value}": f"{heading} {value}" for value in ("target", "fact", "efficiency")})
    return published.withColumnsRenamed(names)


def cumulative_vs_period(
    cards: DataFrame, keys: Sequence[str], *, cutoff: date, start: date, end: date
) -> DataFrame:
    """Cards up to ``cutoff`` and from ``start`` to ``end`` per key, 0 where the period has none."""
    spans = {"total": Span(end=cutoff, due=0), "period": Span(end=end, due=0, start=start)}
    counted = period_counts(cards, keys, spans).where("rows_total > 0")
    return counted.select(*keys, F.col("n_total").alias("done_total"), F.col("n_period").alias("done_period"))


def weekly_facts(cards: DataFrame, weeks_until: date, keys: Iterable[str] = ("unit",)) -> DataFrame:
    """Cards per unit and calendar week (Monday to Sunday) up to a date, for the stored history."""
    keys = list(keys)
    monday = F.date_sub("date_close", F.weekday("date_close"))
    return (
        cards.where(F.col("date_close") <= F.lit(weeks_until))
        .where(present(keys))
        .groupBy(*keys, monday.alias("period_start"))
        .agg(F.count("card_number").alias("fact"))
        .withColumn("period_end", F.date_add("period_start", 6))
    )


def weekly_facts_as_stored(
    cards: DataFrame, weeks_until: date, stored: Column, keys: Iterable[str] = ("unit",)
) -> DataFrame:
    """`weekly_facts`, where a week that had cards when it was stored keeps the count of that time.

    ``stored`` marks the cards the stored weeks were counted from.  The same as
    `freeze_history` of both counts, in one pass over the cards; where the
    stored weeks are a table of their own, that is the one to use.
    """
    keys = list(keys)
    monday = F.date_sub("date_close", F.weekday("date_close"))
    counted = (
        cards.where(F.col("date_close") <= F.lit(weeks_until))
        .where(present(keys))
        .groupBy(*keys, monday.alias("period_start"))
        .agg(
            F.count_if(stored).alias("_rows"),
            F.count(F.when(stored, F.col("card_number"))).alias("_then"),
            F.count("card_number").alias("_now"),
        )
    )
    fact = F.when(F.col("_rows") > 0, F.col("_then")).otherwise(F.col("_now"))
    return counted.select(*keys, "period_start", fact.alias("fact"), F.date_add("period_start", 6).alias("period_end"))
