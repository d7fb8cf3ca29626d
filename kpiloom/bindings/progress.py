"""Plan monitoring on ``orders``: an order is a check-up card, its priority the unit."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from kpiloom.bindings.inputs import stage_folder, table
from kpiloom.functions.dates import date_list, days_heading, period_columns, reporting_period, workdays
from kpiloom.functions.numbers import gap_score
from kpiloom.operators.history import stored_periods, wide_history
from kpiloom.operators.incremental import refreshed_days, row_digests
from kpiloom.operators.lineage import cut_lineage
from kpiloom.plans import progress as P
from kpiloom.sources.config import config_table

AS_OF = date(2001, 7, 26)  # a Thursday
PERIOD = reporting_period(AS_OF)
FLOOR = date(1995, 1, 1)
HOLIDAYS = tuple(date(year, month, day) for year in range(1995, 2002) for month, day in ((1, 1), (1, 2), (5, 1), (11, 4)))
PLAN = P.Plan(annual=2600, year_days=250, holidays=HOLIDAYS, total_label="TOTAL")
WEIGHTS = {"1-URGENT": 0.25, "2-HIGH": 0.2, "3-MEDIUM": 0.225, "4-NOT SPECIFIED": 0.125, "5-LOW": 0.2}
ALLOWED = ("1-URGENT", "3-MEDIUM", "5-LOW")
STORED_UNTIL = date(2000, 12, 31)
# The Mondays of all weeks that the table holds up to the last published one.
ALL_WEEKS = [day for day in date_list(date(1994, 12, 26), PERIOD.past_monday) if day.weekday() == 0]

CUMULATIVE = P.Span(end=PERIOD.past_sunday, due=PLAN.due(FLOOR, PERIOD.past_sunday))
# Counted to yesterday, but measured against the plan up to last Sunday.
YESTERDAY = P.Span(end=PERIOD.yesterday, due=PLAN.due(FLOOR, PERIOD.past_sunday))
WEEK = P.Span(
    start=PERIOD.past_monday, end=PERIOD.past_sunday, due=PLAN.due(PERIOD.past_monday, PERIOD.past_sunday)
)


def cards(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderdate").cast("date").alias("date_close"),
        F.col("o_orderkey").cast("string").alias("card_number"),
        F.col("o_orderpriority").alias("unit"),
        F.concat(F.lit("D"), F.col("o_custkey").cast("string")).alias("doctor_name"),
        F.col("o_orderstatus").alias("state"),
    )


def weights(spark):
    return config_table(spark, WEIGHTS, "unit STRING, weight DOUBLE")


def plan_progress_ytd(spark, folder):
    return P.plan_progress(cards(spark, folder), weights(spark), PLAN, CUMULATIVE)


def plan_progress_yesterday(spark, folder):
    return P.plan_progress(cards(spark, folder), weights(spark), PLAN, YESTERDAY)


def plan_progress_week(spark, folder):
    return P.plan_progress(cards(spark, folder), weights(spark), PLAN, WEEK, annual=False)


def plan_progress_combined(spark, folder):
    return P.plan_progress_combined(cards(spark, folder), weights(spark), PLAN, CUMULATIVE, WEEK)


def gap_scores(spark, folder):
    gap = F.lit(100.0) - F.col("efficiency")
    return plan_progress_ytd(spark, folder).select("unit", gap.alias("gap"), gap_score(gap).alias("points"))


def cumulative_vs_week_unit(spark, folder):
    return P.cumulative_vs_period(
        P.in_scope(cards(spark, folder), ALLOWED), ["unit"],
        cutoff=PERIOD.past_sunday, start=PERIOD.past_monday, end=PERIOD.past_sunday,
    )


def cumulative_vs_week_doctor(spark, folder):
    return P.cumulative_vs_period(
        P.in_scope(cards(spark, folder), ALLOWED), ["unit", "doctor_name"],
        cutoff=PERIOD.past_sunday, start=PERIOD.past_monday, end=PERIOD.past_sunday,
    )


def out_of_scope_rows(spark, folder):
    return P.out_of_scope(cards(spark, folder), ALLOWED)


def history_freeze(spark, folder):
    """Weeks as stored when only the finished orders were known, and today's figures of all others."""
    was_stored = (F.col("state") == "F") & (F.col("date_close") <= F.lit(STORED_UNTIL))
    frozen = P.weekly_facts_as_stored(cards(spark, folder), PERIOD.past_sunday, was_stored)
    return frozen.select("unit", "period_start", "period_end", "fact")


def history_wide(spark, folder):
    """Every stored week beside its unit, the weeks taken from the history, which is stored and then read twice."""
    stage_folder(spark)
    frozen = cut_lineage(history_freeze(spark, folder))
    weeks = stored_periods(frozen, "period_start")
    wide = wide_history(frozen, "unit", "period_start", ["fact"], weeks)
    return wide.select("unit", *[F.col(f"`{week}`").alias(f"week_{week}") for week in weeks])


def reporting_period_days(spark, folder):
    day = F.col("as_of")
    days = cards(spark, folder).groupBy(F.col("date_close").alias("as_of")).agg(F.count(F.lit(1)).alias("cards"))
    columns = period_columns(day)
    return days.withColumns(columns).withColumn("workdays", workdays(F.col("year_start"), day, HOLIDAYS))


def daily_counts_refreshed(spark, folder):
    """Counts stored when only the finished orders were known, brought up to date: unchanged days are as stored."""
    stage_folder(spark)
    now = cards(spark, folder).select("unit", "date_close", "card_number")

    def count(part):
        return part.groupBy("date_close", "unit").agg(F.count("card_number").alias("cards"))

    then = cards(spark, folder).where("state = 'F'").select(*now.columns)
    none = spark.createDataFrame([], "day DATE, digest STRING, unit STRING, cards BIGINT")
    stored = cut_lineage(refreshed_days(then, "date_close", row_digests(then, "date_close"), none, count))
    found = refreshed_days(now, "date_close", row_digests(now, "date_close"), stored, count)
    return found.where("cards IS NOT NULL").drop("digest")


def week_headings(spark, folder):
    """Headings of the weekly columns, with the cards of the week."""
    weeks = P.weekly_facts(cards(spark, folder), PERIOD.past_sunday, keys=[])
    heading = days_heading(F.col("period_start"), F.col("period_end"))
    return weeks.select("period_start", heading.alias("heading"), "fact")


QUERIES = {
    "daily_counts_refreshed": daily_counts_refreshed,
    "week_headings": week_headings,
    "plan_progress_ytd": plan_progress_ytd,
    "plan_progress_yesterday": plan_progress_yesterday,
    "plan_progress_week": plan_progress_week,
    "plan_progress_combined": plan_progress_combined,
    "gap_scores": gap_scores,
    "cumulative_vs_week_unit": cumulative_vs_week_unit,
    "cumulative_vs_week_doctor": cumulative_vs_week_doctor,
    "out_of_scope_rows": out_of_scope_rows,
    "history_freeze": history_freeze,
    "history_wide": history_wide,
    "reporting_period": reporting_period_days,
}

_HOLIDAYS_SQL = ", ".join(f"DATE '{day}'" for day in HOLIDAYS)
_ALLOWED_SQL = ", ".join(f"'{unit}'" for unit in ALLOWED)
_WEIGHTS_SQL = "(VALUES " + ", ".join(f"('{unit}', {weight}::DOUBLE)" for unit, weight in WEIGHTS.items()) + ") AS w(unit, weight)"


def _workdays_sql(start, end) -> str:
    return (
        f"(SELECT count(*) FROM generate_series(DATE '{start}', DATE '{end}', INTERVAL 1 DAY) AS g(d) "
        f"WHERE isodow(d) < 6 AND CAST(d AS DATE) NOT IN ({_HOLIDAYS_SQL}))"
    )


def _progress_sql(condition: str, start, end, name: str) -> str:
    """Rows per unit and total of one span, as two common table expressions."""
    exact = f"(({PLAN.annual} // {PLAN.year_days}) * {_workdays_sql(start, end)} * weight)"
    return f"""
    {name}_rows AS (
      SELECT o_orderpriority AS unit, CAST(trunc({PLAN.annual} * max(weight)) AS BIGINT) AS annual_plan,
             CAST(trunc(any_value{exact}) AS BIGINT) AS target, count(o_orderkey) AS done,
             round_even(100 * count(o_orderkey) / any_value{exact} * 100, 0) / 100 AS efficiency
      FROM orders JOIN {_WEIGHTS_SQL} ON w.unit = o_orderpriority WHERE {condition} GROUP BY o_orderpriority),
    {name} AS (
      SELECT * FROM {name}_rows UNION ALL
      SELECT 'TOTAL', CAST(sum(annual_plan) AS BIGINT), CAST(sum(target) AS BIGINT), CAST(sum(done) AS BIGINT),
             round_even(100 * sum(done) / sum(target) * 100, 0) / 100 FROM {name}_rows)"""


_UNTIL_SUNDAY = f"CAST(o_orderdate AS DATE) <= DATE '{PERIOD.past_sunday}'"
_UNTIL_YESTERDAY = f"CAST(o_orderdate AS DATE) <= DATE '{PERIOD.yesterday}'"
_IN_WEEK = f"CAST(o_orderdate AS DATE) BETWEEN DATE '{PERIOD.past_monday}' AND DATE '{PERIOD.past_sunday}'"
_YTD_SQL = _progress_sql(_UNTIL_SUNDAY, FLOOR, PERIOD.past_sunday, "ytd")
_WEEK_SQL = _progress_sql(_IN_WEEK, PERIOD.past_monday, PERIOD.past_sunday, "week")


def _facts_sql(condition: str) -> str:
    return f"""SELECT o_orderpriority AS unit, CAST(date_trunc('week', o_orderdate) AS DATE) AS period_start,
        CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS period_end, count(o_orderkey) AS fact
        FROM orders WHERE {condition} GROUP BY 1, 2, 3"""


_HISTORY_SQL = f"""stored AS ({_facts_sql(f"o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) <= DATE '{STORED_UNTIL}'")}),
    fresh AS ({_facts_sql(_UNTIL_SUNDAY)}),
    frozen AS (SELECT * FROM stored UNION ALL SELECT * FROM fresh f WHERE NOT EXISTS (
        SELECT 1 FROM stored s WHERE s.unit = f.unit AND s.period_start = f.period_start))"""


def _cumulative_sql(keys: str) -> str:
    return f"""SELECT {keys}, count(o_orderkey) AS done_total, count(o_orderkey) FILTER (WHERE {_IN_WEEK}) AS done_period
        FROM (SELECT *, o_orderpriority AS unit, 'D' || o_custkey AS doctor_name FROM orders)
        WHERE unit IN ({_ALLOWED_SQL}) AND {_UNTIL_SUNDAY} GROUP BY {keys}"""


ORACLES = {
    "daily_counts_refreshed": """SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS unit, count(o_orderkey) AS cards
        FROM orders GROUP BY 1, 2""",
    "week_headings": f"""SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS period_start,
        strftime(date_trunc('week', o_orderdate), '%d.%m') || '-' || strftime(CAST(date_trunc('week', o_orderdate) AS DATE) + 6, '%d.%m')
        AS heading, count(o_orderkey) AS fact FROM orders WHERE {_UNTIL_SUNDAY} GROUP BY 1, 2""",
    "plan_progress_ytd": f"WITH {_YTD_SQL} SELECT * FROM ytd",
    "plan_progress_yesterday": f"WITH {_progress_sql(_UNTIL_YESTERDAY, FLOOR, PERIOD.past_sunday, 'p')} SELECT * FROM p",
    "plan_progress_week": f"WITH {_WEEK_SQL} SELECT unit, target, done, efficiency FROM week",
    "plan_progress_combined": f"""WITH {_YTD_SQL}, {_WEEK_SQL}
        SELECT y.*, w.target AS target_week, w.done AS done_week, w.efficiency AS efficiency_week
        FROM ytd y LEFT JOIN week w USING (unit)""",
    "gap_scores": f"""WITH {_YTD_SQL} SELECT unit, 100.0::DOUBLE - efficiency AS gap,
        CASE WHEN 100 - efficiency < 1.97 THEN 5 WHEN 100 - efficiency < 3 THEN 3 ELSE 0 END AS points FROM ytd""",
    "cumulative_vs_week_unit": _cumulative_sql("unit"),
    "cumulative_vs_week_doctor": _cumulative_sql("unit, doctor_name"),
    "out_of_scope_rows": f"""SELECT o_orderpriority AS unit, 'D' || o_custkey AS doctor_name,
        CAST(o_orderkey AS VARCHAR) AS card_number, strftime(o_orderdate, '%Y-%m-%d') AS date_close
        FROM orders WHERE NOT coalesce(o_orderpriority IN ({_ALLOWED_SQL}), false)""",
    "history_freeze": f"WITH {_HISTORY_SQL} SELECT * FROM frozen",
    "history_wide": f"WITH {_HISTORY_SQL} SELECT unit, "
    + ", ".join(f"max(fact) FILTER (WHERE period_start = DATE '{week}') AS \"week_{week}\"" for week in ALL_WEEKS)
    + " FROM frozen GROUP BY unit",
    "reporting_period": f"""WITH d AS (SELECT CAST(o_orderdate AS DATE) AS as_of, count(*) AS cards FROM orders GROUP BY 1),
        p AS (SELECT *, CAST(date_trunc('week', as_of) AS DATE) AS monday,
              CAST(date_trunc('year', as_of) AS DATE) AS year_start FROM d)
        SELECT as_of, cards, CASE WHEN isodow(as_of) = 1 THEN monday - 7 ELSE monday END AS first_date,
               as_of AS last_date, as_of - 1 AS yesterday, monday - 7 AS past_monday, monday - 1 AS past_sunday,
               year_start, (SELECT count(*) FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) AS g(x)
                WHERE x >= year_start AND x <= as_of AND isodow(x) < 6 AND CAST(x AS DATE) NOT IN ({_HOLIDAYS_SQL})) AS workdays
        FROM p""",
}
