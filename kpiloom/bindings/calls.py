"""Call statistics on ``events``."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from kpiloom.bindings.inputs import EVENT_NUMBER_SQL, numbered_events, table
from kpiloom.functions.dates import date_list
from kpiloom.plans import calls as C

AS_OF = date(2024, 1, 30)
LINE = 7001
AGENTS = tuple((f"ext{digit}", f"Agent {name}") for digit, name in zip(range(7), "ABCDEFG"))
DAYS = [day.isoformat() for day in date_list(AS_OF - timedelta(days=10), AS_OF)]


def calls(spark, folder):
    kind = F.col("event_type")
    raw = numbered_events(table(spark, folder, "events")).select(
        F.when(kind == "view", 7000).otherwise(LINE).cast("long").alias("incoming_line"),
        F.concat(F.lit("SIP/ext"), F.lpad(F.col("k").cast("string"), 2, "0"), F.lit("-0a")).alias("first_answerer"),
        F.when(kind.isin("click", "signup"), "успешный").when(kind == "error", "пропущенный").otherwise("занято").alias("status"),
        F.when(F.col("value") >= 0.1, "входящий").alias("type"),
        F.date_format("ts", "yyyy-MM-dd").alias("call_date"),
        F.date_format("ts", "HH:mm:ss").alias("call_time"),
    )
    return C.line_calls(raw, line=LINE, agents=AGENTS)


def calls_by_status(spark, folder):
    return C.calls_by_status(calls(spark, folder))


def calls_by_agent(spark, folder):
    return C.calls_by_agent(calls(spark, folder))


def calls_pivot_10d(spark, folder):
    return C.answered_by_day(calls(spark, folder), as_of=AS_OF)


def calls_missed_daily(spark, folder):
    return C.missed_by_day(calls(spark, folder), as_of=AS_OF)


def call_board_10d(spark, folder):
    return C.call_board(calls(spark, folder), as_of=AS_OF)


def calls_totals_10d(spark, folder):
    return C.recent_totals(calls(spark, folder), as_of=AS_OF)


QUERIES = {
    "calls_by_status": calls_by_status,
    "calls_by_agent": calls_by_agent,
    "calls_pivot_10d": calls_pivot_10d,
    "calls_missed_daily": calls_missed_daily,
    "call_board_10d": call_board_10d,
    "calls_totals_10d": calls_totals_10d,
}

_CALLS_SQL = f"""calls AS (
    SELECT CASE {EVENT_NUMBER_SQL} // 10 {" ".join(f"WHEN {n} THEN '{label}'" for n, (_, label) in enumerate(AGENTS))} END AS agent,
           CASE WHEN event_type IN ('click', 'signup') THEN 'успешный' WHEN event_type = 'error' THEN 'пропущенный' ELSE 'занято' END AS status,
           CASE WHEN value >= 0.1 THEN 'входящий' END AS type, CAST(ts AS DATE) AS call_date
    FROM events WHERE event_type <> 'view'),
  recent AS (SELECT * FROM calls WHERE call_date BETWEEN DATE '{AS_OF}' - 10 AND DATE '{AS_OF}')"""
_DAY_COUNTS = ", ".join(f"count(*) FILTER (WHERE call_date = DATE '{day}') AS \"{day}\"" for day in DAYS)
_BOARD_SQL = f"""SELECT agent, {_DAY_COUNTS} FROM recent WHERE status = 'успешный' AND agent IS NOT NULL GROUP BY agent
    UNION ALL SELECT 'TOTAL', {_DAY_COUNTS} FROM recent WHERE status = 'успешный' AND agent IS NOT NULL"""

ORACLES = {
    "calls_by_status": f"WITH {_CALLS_SQL} SELECT status, count(type) AS calls FROM calls GROUP BY status",
    "calls_by_agent": f"""WITH {_CALLS_SQL} SELECT agent, count(type) AS answered FROM calls
        WHERE status = 'успешный' AND agent IS NOT NULL GROUP BY agent""",
    "calls_pivot_10d": f"WITH {_CALLS_SQL} {_BOARD_SQL}",
    "calls_missed_daily": f"""WITH {_CALLS_SQL} SELECT CAST(g AS DATE) AS call_date,
        (SELECT count(*) FROM recent WHERE status = 'пропущенный' AND recent.call_date = CAST(g AS DATE)) AS missed
        FROM generate_series(DATE '{AS_OF}' - 10, DATE '{AS_OF}', INTERVAL 1 DAY) AS s(g)""",
    "call_board_10d": f"""WITH {_CALLS_SQL} {_BOARD_SQL}
        UNION ALL SELECT 'MISSED', {_DAY_COUNTS} FROM recent WHERE status = 'пропущенный'""",
    "calls_totals_10d": f"""WITH {_CALLS_SQL} SELECT 'answered' AS label, count(*) AS value FROM recent WHERE status = 'успешный'
        UNION ALL SELECT 'missed', count(*) FROM recent WHERE status = 'пропущенный'""",
}
