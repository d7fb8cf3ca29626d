"""Closures, bookings and prescriptions on ``events``.

A person is a user at an hour of the day; purchases are prescriptions, all
other events bookings.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from kpiloom.bindings.inputs import EVENT_NUMBER_SQL, labels, numbered_events, steps, steps_sql, table
from kpiloom.functions.text import booking_name
from kpiloom.operators.rows import first_rows, quality
from kpiloom.plans import closures as K
from kpiloom.plans import prescriptions as R
from kpiloom.sources.config import config_table

AS_OF = date(2024, 1, 29)
FIRST, LAST = date(2024, 1, 1), date(2024, 1, 30)
ORG = 77
MAIN_SITE = "Главный корпус"
DEPARTMENTS = (
    (15, "ОСП 1 терапия"), (30, "ОСП 1 хирургия"), (45, "Поликлиника ОСП №3 каб. 1"), (60, "ЦАОП 2 этаж"), (75, "Ленинградская п-ка"),
    (85, None), (100, "Иное отделение"),
)
CLOSING_UNITS = ((25, "ОСП 1 каб. 4"), (50, "ОСП 2 поликлиника"), (75, "Поликлиника ОСП 3"), (100, "Женская консультация"))
CLOSING_PLAN = {"ОСП 1": 910, "ОСП 2": 275, MAIN_SITE: 430}
EXAMS = {"signup": "404н Диспансеризация", "click": "404н Профилактические медицинские осмотры", "purchase": "Углубленная"}
MARKS = {"error": "Неявка", "view": "Запись отменена", "click": "Явка"}


def _person():
    return F.concat(F.lit("Юз"), F.col("user_id").cast("string"), F.lit(" Час"), F.hour("ts").cast("string"), F.lit(" Петрович"))


def bookings(spark, folder):
    subdivision = F.when((F.col("event_type") == "signup") & (F.col("value") > 40), "ИТОГО по кабинету").otherwise(
        steps(F.col("k"), DEPARTMENTS)
    )
    name = F.when(F.col("value") < 1, F.concat(F.lit("№1 Юз"), F.col("user_id").cast("string"))).otherwise(
        F.concat(F.lit("№"), F.col("event_id").cast("string"), F.lit(" "), _person(), F.lit(", 1.1.1990"))
    )
    return numbered_events(table(spark, folder, "events").where("event_type <> 'purchase'")).select(
        subdivision.alias("subdivision"),
        F.concat(F.lit("к"), F.col("k").cast("string")).alias("room"),
        name.alias("patient_name"),
        F.when(F.col("value") > 20, F.date_trunc("day", "ts").cast("timestamp_ntz")).otherwise(F.col("ts")).alias("booked_at"),
        labels(F.col("event_type"), MARKS).alias("mark"),
        F.col("event_id").alias("seq"),
    )


def prescriptions(spark, folder):
    return numbered_events(table(spark, folder, "events").where("event_type = 'purchase'")).select(
        steps(F.col("k"), DEPARTMENTS).alias("department"),
        F.concat(F.lit("S"), F.col("event_id").cast("string")).alias("series_number"),
        F.date_format("ts", "dd.MM.yyyy").alias("issue_date"),
        F.concat(F.lit("D"), F.col("user_id").cast("string")).alias("doctor_name"),
        F.col("user_id").cast("string").alias("insurance_no"),
        _person().alias("patient_name"),
        F.col("k").cast("string").alias("category_code"),
        F.lit("ул. Новая").alias("address"),
        F.lit("препарат").alias("drug"),
        F.col("value").alias("quantity"),
        F.col("event_id").alias("seq"),
    )


def report(spark, folder):
    return numbered_events(table(spark, folder, "events")).select(
        F.when(F.col("event_type") == "error", 78).otherwise(ORG).cast("long").alias("org_id"),
        steps(F.col("k"), CLOSING_UNITS).alias("unit"),
        F.date_format("ts", "dd.MM.yyyy HH:mm:ss").alias("closed_at"),
        F.when(F.col("event_type") == "view", "Отказ").otherwise("Обследование пройдено").alias("close_reason"),
        labels(F.col("event_type"), EXAMS).alias("exam_type"),
    )


def weekday_pivot_plan(spark, folder):
    plan = config_table(spark, CLOSING_PLAN, "unit STRING, plan BIGINT")
    return K.weekday_closures(report(spark, folder), plan, org_id=ORG, main_site=MAIN_SITE, first=FIRST, last=LAST)


def closure_plan_pct(spark, folder):
    return K.closure_rates(weekday_pivot_plan(spark, folder), "TOTAL")


def first_per_key(spark, folder):
    events = table(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))
    return first_rows(events, ["user_id", "day"], ["ts", "event_id"]).select("user_id", "day", "event_id", "event_type", "value")


def latest_per_key(spark, folder):
    events = table(spark, folder, "events")
    return first_rows(events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")], null_keys=True).select(
        "user_id", "event_type", "event_id", "ts"
    )


def booking_status_clean(spark, folder):
    kept, noshow = R.clean_bookings(bookings(spark, folder), as_of=AS_OF)
    columns = ["seq", "subdivision", "room", "patient_name", "booked_at", "booked_date", "mark"]
    return kept.select(F.lit("kept").alias("part"), *columns).unionByName(
        noshow.select(F.lit("noshow").alias("part"), *columns)
    )


def _pair(spark, folder):
    kept, noshow = R.clean_bookings(bookings(spark, folder), as_of=AS_OF)
    return R.first_prescriptions(prescriptions(spark, folder)), kept, noshow


def missing_booking(spark, folder):
    issued, kept, _ = _pair(spark, folder)
    return R.missing_booking(issued, kept, as_of=AS_OF).drop("seq")


def noshow_but_fulfilled(spark, folder):
    issued, _, noshow = _pair(spark, folder)
    return R.noshow_fulfilled(noshow, issued)


def compliance_by_unit(spark, folder):
    issued, kept, _ = _pair(spark, folder)
    return R.compliance(issued, kept, as_of=AS_OF)


def compliance_rollup(spark, folder):
    return R.compliance_rollup(compliance_by_unit(spark, folder), "TOTAL")


def booking_quality(spark, folder):
    return quality(
        bookings(spark, folder),
        {
            "no_subdivision": F.col("subdivision").isNull(),
            "no_name": booking_name(F.col("patient_name")).isNull(),
            "no_mark": F.col("mark").isNull(),
        },
    )


QUERIES = {
    "weekday_pivot_plan": weekday_pivot_plan,
    "closure_plan_pct": closure_plan_pct,
    "first_per_key": first_per_key,
    "latest_per_key": latest_per_key,
    "booking_status_clean": booking_status_clean,
    "missing_booking": missing_booking,
    "noshow_but_fulfilled": noshow_but_fulfilled,
    "compliance_by_unit": compliance_by_unit,
    "compliance_rollup": compliance_rollup,
    "booking_quality": booking_quality,
}

_WEEKDAYS = ("Понедельник", "Вторник", "Среда", "Четверг", "Пятница", "Суббота", "Воскресенье")
_CLOSURES_SQL = f"""c AS (
    SELECT CASE WHEN regexp_matches(u, '^ОСП [0-9]') THEN regexp_extract(u, 'ОСП [0-9]', 0) ELSE '{MAIN_SITE}' END AS unit, isodow(ts) AS wd
    FROM (SELECT {steps_sql(EVENT_NUMBER_SQL, CLOSING_UNITS)} AS u, ts, event_type FROM events)
    WHERE event_type IN ('signup', 'click') AND CAST(ts AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}'),
  closures AS (
    SELECT unit, {", ".join(f'nullif(count(*) FILTER (WHERE wd = {n + 1}), 0) AS "{name}"' for n, name in enumerate(_WEEKDAYS))},
           count(*) AS total,
           CAST(CASE unit {" ".join(f"WHEN '{unit}' THEN {plan}" for unit, plan in CLOSING_PLAN.items())} END AS BIGINT) AS plan
    FROM c GROUP BY unit)"""

_PERSON_SQL = "'Юз' || user_id || ' Час' || hour(ts) || ' Петрович'"
_DEPARTMENT_SQL = steps_sql(EVENT_NUMBER_SQL, DEPARTMENTS)


def _department_rule(column: str) -> str:
    return f"""CASE WHEN regexp_matches({column}, 'ОСП №?[0-9]') THEN regexp_extract({column}, 'ОСП №?[0-9]', 0)
        WHEN {column} LIKE '%ЦАОП%' THEN 'ЦАОП' WHEN {column} LIKE '%Ленинградская%' THEN 'Ленинградская 9'
        WHEN {column} IS NULL THEN 'Не указано' ELSE {column} END"""


_RECONCILE_SQL = f"""b AS (
    SELECT * FROM (SELECT event_id AS seq,
        CASE WHEN event_type = 'signup' AND value > 40 THEN 'ИТОГО по кабинету' ELSE {_DEPARTMENT_SQL} END AS subdivision,
        'к' || {EVENT_NUMBER_SQL} AS room, CASE WHEN value >= 1 THEN upper({_PERSON_SQL}) END AS patient_name,
        CASE WHEN value > 20 THEN date_trunc('day', ts) ELSE ts END AS booked_at, CAST(ts AS DATE) AS booked_date,
        CASE event_type WHEN 'error' THEN 'Неявка' WHEN 'view' THEN 'Запись отменена' WHEN 'click' THEN 'Явка' END AS mark
      FROM events WHERE event_type <> 'purchase')
    WHERE NOT coalesce(regexp_matches(subdivision, '(?i)максимум|итог|среднее|количество'), false) AND patient_name IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY patient_name, booked_date ORDER BY seq) = 1),
  noshow AS (SELECT * FROM b WHERE mark = 'Неявка' AND booked_at < TIMESTAMP '{AS_OF} 00:00:00'),
  kept AS (SELECT * REPLACE (CASE WHEN mark = 'Неявка' THEN 'Запланирован' ELSE mark END AS mark) FROM b
    WHERE NOT coalesce(mark = 'Неявка' AND booked_at < TIMESTAMP '{AS_OF} 00:00:00', false)
      AND mark IS NOT NULL AND mark NOT IN ('Запись отменена', 'Запись перенесена')),
  rx AS (
    SELECT {_DEPARTMENT_SQL} AS department, 'S' || event_id AS series_number, CAST(ts AS DATE) AS issue_date,
           'D' || user_id AS doctor_name, CAST(user_id AS VARCHAR) AS insurance_no, upper({_PERSON_SQL}) AS patient_name,
           json_extract_string(props, '$.k') AS category_code, 'ул. Новая' AS address, 'препарат' AS drug, value AS quantity,
           {_department_rule(f"({_DEPARTMENT_SQL})")} AS subdivision
    FROM events WHERE event_type = 'purchase'
    QUALIFY row_number() OVER (PARTITION BY {_PERSON_SQL}, CAST(ts AS DATE) ORDER BY event_id) = 1),
  by_unit AS (
    SELECT department, count(*) AS prescriptions, count(booked_at) AS by_rule,
           CAST(round_even(100 * count(booked_at) / count(*), 0) AS BIGINT) AS by_rule_pct
    FROM rx LEFT JOIN kept ON kept.patient_name = rx.patient_name AND kept.booked_date = rx.issue_date
    WHERE issue_date < DATE '{AS_OF}' AND department IS NOT NULL GROUP BY department)"""

_BOOKING_COLUMNS = "seq, subdivision, room, patient_name, booked_at, booked_date, mark"

ORACLES = {
    "weekday_pivot_plan": f"WITH {_CLOSURES_SQL} SELECT * FROM closures",
    "closure_plan_pct": f"""WITH {_CLOSURES_SQL}
        SELECT unit, CAST(round_even(total / plan * 100, 0) AS BIGINT) AS plan_pct FROM closures UNION ALL
        SELECT 'TOTAL', CAST(round_even(sum(total) / sum(plan) * 100, 0) AS BIGINT) FROM closures""",
    "first_per_key": """SELECT user_id, CAST(ts AS DATE) AS day, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1""",
    "latest_per_key": """SELECT user_id, event_type, event_id, ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "booking_status_clean": f"""WITH {_RECONCILE_SQL} SELECT 'kept' AS part, {_BOOKING_COLUMNS} FROM kept
        UNION ALL SELECT 'noshow', {_BOOKING_COLUMNS} FROM noshow""",
    "missing_booking": f"""WITH {_RECONCILE_SQL} SELECT * FROM rx WHERE issue_date >= DATE '{AS_OF}'
        AND NOT EXISTS (SELECT 1 FROM kept WHERE kept.patient_name = rx.patient_name)""",
    "noshow_but_fulfilled": f"""WITH {_RECONCILE_SQL}
        SELECT n.patient_name, n.subdivision AS booking_subdivision, n.room,
               replace(strftime(n.booked_at, '%Y-%m-%d %H:%M'), '00:00', 'вне расписания') AS booked_at, rx.series_number,
               rx.doctor_name, rx.category_code, rx.address, rx.drug, rx.quantity, rx.subdivision AS issuing_subdivision
        FROM noshow n JOIN rx ON n.patient_name = rx.patient_name AND n.booked_date = rx.issue_date""",
    "compliance_by_unit": f"WITH {_RECONCILE_SQL} SELECT * FROM by_unit",
    "compliance_rollup": f"""WITH {_RECONCILE_SQL}, up AS (
        SELECT {_department_rule("department")} AS subdivision, CAST(sum(prescriptions) AS BIGINT) AS prescriptions,
               CAST(sum(by_rule) AS BIGINT) AS by_rule FROM by_unit GROUP BY 1),
        t AS (SELECT * FROM up UNION ALL SELECT 'TOTAL', CAST(sum(prescriptions) AS BIGINT), CAST(sum(by_rule) AS BIGINT) FROM up)
        SELECT *, CAST(round_even(by_rule / prescriptions * 100, 0) AS BIGINT) AS rate_pct FROM t""",
    "booking_quality": f"""SELECT count(*) AS rows,
        count(*) FILTER (WHERE (CASE WHEN event_type = 'signup' AND value > 40 THEN '' ELSE {_DEPARTMENT_SQL} END) IS NULL) AS no_subdivision,
        count(*) FILTER (WHERE value < 1) AS no_name,
        count(*) FILTER (WHERE event_type = 'signup') AS no_mark FROM events WHERE event_type <> 'purchase'""",
}
