"""Schedule cells on ``events`` and ``customer``: a user is a resource, an event a cell of 15 minutes."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from kpiloom.bindings.inputs import labels, labels_sql, steps, steps_sql, table
from kpiloom.functions.numbers import access_flags
from kpiloom.plans import slots as S

NOW = datetime(2024, 1, 27, 12, 0)
FIRST = date(2024, 1, 5)
TYPES = {"BUILDING": "Врач", "HOUSEHOLD": "Врач", "MACHINERY": "Оборудование", "AUTOMOBILE": "Оборудование", "FURNITURE": "Кабинет"}
SPECIALTIES = ((6, 1815), (10, 1895), (16, 2001), (21, 2002))
EQUIPMENT = ((4, "Рентген"), (12, "Магнитно-резонансный томограф"), (17, "Компьютерный томограф"), (22, "Компьютерные томографы"))
ROOMS = ((8, "101"), (12, "Стационар 2"), (14, None), (20, "204"))


def cells(spark, folder):
    """Events as cells; what a cell tells about its resource is its event type as department."""
    code = F.when(F.col("value") < 128, F.floor("value").cast("int"))
    return table(spark, folder, "events").select(
        F.col("user_id").alias("resource_id"),
        F.col("ts").alias("begin_time"),
        (F.col("ts") + F.expr("INTERVAL 15 MINUTES")).alias("end_time"),
        code.alias("access_code"),
        F.col("event_type").isin("purchase", "error").cast("int").alias("is_used"),
        F.col("event_type").alias("department_name"),
        "event_id",
        *[flag.alias(right) for right, flag in access_flags(code).items()],
    )


def named(spark, folder, found):
    """One row per resource with the resource's own attributes, from ``customer``."""
    nation = F.col("c_nationkey")
    resources = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("resource_id"),
        labels(F.col("c_mktsegment"), TYPES).alias("resource_type"),
        F.concat(F.lit("ВРАЧ "), "c_name").alias("doctor_full_name"),
        F.concat(F.lit("аппарат "), "c_name").alias("equipment_name"),
        steps(nation, EQUIPMENT, "УЗИ").alias("equipment_type"),
        steps(nation, ROOMS, "305").alias("cabinet_number"),
        steps(nation, SPECIALTIES).alias("specialty_id"),
        F.concat(F.lit("спец "), nation.cast("string")).alias("specialty_name"),
        F.concat(F.lit("ОСП "), nation.cast("string")).alias("subdivision_name"),
    )
    return found.join(resources, "resource_id")


def calendar_gaps(spark, folder):
    gaps = S.date_gaps(cells(spark, folder), first=FIRST, tie_break=["event_id"])
    return S.doctor_gaps(named(spark, folder, gaps))


def _found(spark, folder):
    return named(spark, folder, S.first_free_cells(cells(spark, folder), now=NOW, tie_break=["event_id"]))


def nearest_slot_gp(spark, folder):
    return S.general_practice_waits(_found(spark, folder))


def nearest_slot_specialist(spark, folder):
    return S.specialist_waits(_found(spark, folder))


def nearest_slot_equipment(spark, folder):
    return S.equipment_waits(_found(spark, folder))


def open_minutes_today(spark, folder):
    return S.open_minutes(cells(spark, folder), day=NOW.date())


QUERIES = {
    "calendar_gaps": calendar_gaps,
    "nearest_slot_gp": nearest_slot_gp,
    "nearest_slot_specialist": nearest_slot_specialist,
    "nearest_slot_equipment": nearest_slot_equipment,
    "open_minutes_today": open_minutes_today,
}

_CELLS_SQL = f"""cells AS (
    SELECT user_id AS resource_id, event_id, ts AS begin_time, ts + INTERVAL 15 MINUTE AS end_time,
           {labels_sql("c_mktsegment", TYPES)} AS resource_type, 'ВРАЧ ' || c_name AS doctor_full_name,
           'аппарат ' || c_name AS equipment_name, {steps_sql("c_nationkey", EQUIPMENT, "УЗИ")} AS equipment_type,
           {steps_sql("c_nationkey", ROOMS, "305")} AS cabinet_number, CASE WHEN value < 128 THEN CAST(floor(value) AS INTEGER) END AS access_code,
           event_type IN ('purchase', 'error') AS is_used, {steps_sql("c_nationkey", SPECIALTIES)} AS specialty_id,
           'спец ' || c_nationkey AS specialty_name, event_type AS department_name, 'ОСП ' || c_nationkey AS subdivision_name
    FROM events LEFT JOIN customer ON c_custkey = user_id)"""


def _nearest_sql(kind: str, columns: str, flags: dict) -> str:
    waits = ", ".join(
        f"""CAST(coalesce(date_diff('day', DATE '{NOW:%Y-%m-%d}', CAST(arg_min(end_time, (begin_time, event_id))
            FILTER (WHERE access_code & {bit} > 0) AS DATE)), 9999) AS INTEGER) AS {name}"""
        for name, bit in flags.items()
    )
    firsts = ", ".join(
        f"list({column} ORDER BY begin_time, event_id)[1] AS {column}" for column in columns.split(", ")
    )
    return f"""slots AS (SELECT resource_id, {firsts}, {waits} FROM cells
        WHERE NOT is_used AND end_time > TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}' AND resource_type = '{kind}' GROUP BY resource_id)"""


_DOCTORS_SQL = _nearest_sql(
    "Врач",
    "subdivision_name, department_name, doctor_full_name, specialty_name, specialty_id",
    {"wait_days": 2, "self_booking_wait_days": 4},
)

ORACLES = {
    "calendar_gaps": f"""WITH {_CELLS_SQL},
        r AS (SELECT resource_id, arg_min(resource_type, (begin_time, event_id)) AS resource_type,
              arg_min(subdivision_name, (begin_time, event_id)) AS subdivision_name,
              arg_min(department_name, (begin_time, event_id)) AS department_name,
              arg_min(doctor_full_name, (begin_time, event_id)) AS doctor_full_name FROM cells GROUP BY resource_id),
        have AS (SELECT DISTINCT resource_id, CAST(begin_time AS DATE) AS d FROM cells),
        horizon AS (SELECT CAST(g AS DATE) AS d FROM generate_series(DATE '{FIRST}', DATE '{FIRST}' + 21, INTERVAL 1 DAY) AS s(g)),
        gaps AS (SELECT resource_id, string_agg(strftime(d, '%Y-%m-%d'), ', ' ORDER BY d) AS missing_dates
                 FROM r CROSS JOIN horizon WHERE NOT EXISTS (
                   SELECT 1 FROM have WHERE have.resource_id = r.resource_id AND have.d = horizon.d) GROUP BY resource_id)
        SELECT r.*, missing_dates FROM r JOIN gaps USING (resource_id) WHERE resource_type = 'Врач'""",
    "nearest_slot_gp": f"""WITH {_CELLS_SQL}, {_DOCTORS_SQL} SELECT * EXCLUDE (specialty_id) FROM slots
        WHERE specialty_id IN (1815, 1816, 1857, 1858, 1895) AND (wait_days > 1 OR self_booking_wait_days > 1)""",
    "nearest_slot_specialist": f"""WITH {_CELLS_SQL}, {_DOCTORS_SQL} SELECT * EXCLUDE (specialty_id) FROM slots
        WHERE NOT coalesce(specialty_id IN (1815, 1816, 1857, 1858, 1895), false)
          AND (wait_days > 10 OR self_booking_wait_days > 10)""",
    "nearest_slot_equipment": f"""WITH {_CELLS_SQL}, {_nearest_sql(
        "Оборудование", "subdivision_name, department_name, equipment_name, cabinet_number, equipment_type", {"wait_days": 2})}
        SELECT * EXCLUDE (equipment_type) FROM slots
        WHERE equipment_type IN ('Магнитно-резонансный томограф', 'Компьютерный томограф', 'Компьютерные томографы')
          AND cabinet_number NOT LIKE '%Стационар%'""",
    "open_minutes_today": f"""WITH {_CELLS_SQL}
        SELECT resource_id, CAST(sum(date_diff('microsecond', begin_time, end_time)) AS BIGINT) / 60000000 AS open_minutes FROM cells
        WHERE access_code IS DISTINCT FROM 111 AND begin_time > TIMESTAMP '{NOW:%Y-%m-%d} 00:00:00'
          AND begin_time < TIMESTAMP '{NOW:%Y-%m-%d} 00:00:00' + INTERVAL 1 DAY GROUP BY resource_id""",
}
