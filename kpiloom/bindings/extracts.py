"""Extract views and visit recency on the order tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from kpiloom.bindings.inputs import stage_folder, table
from kpiloom.functions.numbers import access_flags
from kpiloom.operators.incremental import refreshed_latest
from kpiloom.operators.joins import rows_without
from kpiloom.operators.lineage import cut_lineage
from kpiloom.plans import extracts as X
from kpiloom.plans import recency as V

FLOOR = date(1995, 1, 1)
AS_OF = date(2001, 8, 5)
REASON = "0c4e9f52-0000-4000-8000-00000000000a"
KINDS = ("0c4e9f52-0000-4000-8000-000000000001", "0c4e9f52-0000-4000-8000-000000000002")


def _units(spark, folder):
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return {
        "departments": nation.select(
            F.col("n_nationkey").alias("department_id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("subdivision_id")
        ),
        "subdivisions": region.select(F.col("r_regionkey").alias("subdivision_id"), F.col("r_name").alias("name")),
    }


def _doctors(spark, folder):
    """Suppliers as doctors; one with a negative balance has no middle name."""
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("doctor_id"),
        F.col("s_name").alias("last_name"),
        F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("first_name"),
        F.when(F.col("s_acctbal") >= 0, "Иванович").alias("middle_name"),
    )


def _code():
    return (F.col("l_quantity").cast("int") + F.col("l_linenumber") * 11).cast("int")


def star_schedule(spark, folder):
    """Line items as cells, parts as resources; sizes 1 to 5 are not shown in the schedule."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    part = table(spark, folder, "part")
    begin = F.col("l_shipdate")
    tables = {
        "cells": table(spark, folder, "lineitem").select(
            begin.alias("date"),
            begin.alias("begin_time"),
            (begin + F.expr("INTERVAL 15 MINUTES")).alias("end_time"),
            F.col("l_linenumber").alias("busy_type_id"),
            F.col("l_suppkey").alias("doctor_id"),
            F.col("l_partkey").alias("resource_id"),
            _code().alias("access_code"),
            (F.col("l_returnflag") == "R").cast("int").alias("is_used"),
            (F.col("l_linestatus") == "O").cast("int").alias("is_out_schedule"),
        ),
        "busy_types": region.select(F.col("r_regionkey").alias("busy_type_id"), F.col("r_name").alias("name")),
        "doctors": _doctors(spark, folder),
        "resources": part.select(
            F.col("p_partkey").alias("resource_id"),
            F.floor(F.col("p_size") / 10).cast("int").alias("resource_type_id"),
            F.col("p_size").alias("equipment_id"),
            F.floor(F.col("p_size") / 2).cast("int").alias("room_id"),
            F.col("p_size").alias("specialty_id"),
            F.floor(F.col("p_size") / 2).cast("int").alias("department_id"),
            (F.col("p_size") > 5).cast("int").alias("in_time"),
        ),
        "resource_types": region.select(F.col("r_regionkey").alias("resource_type_id"), F.col("r_name").alias("name")),
        "equipment": nation.select(
            F.col("n_nationkey").alias("equipment_id"),
            F.concat(F.lit("eq "), "n_name").alias("name"),
            F.col("n_regionkey").alias("equipment_type_id"),
        ),
        "equipment_types": region.select(F.col("r_regionkey").alias("equipment_type_id"), F.col("r_name").alias("name")),
        "rooms": nation.select(F.col("n_nationkey").alias("room_id"), F.col("n_name").alias("number")),
        "specialties": nation.select(F.col("n_nationkey").alias("specialty_id"), F.col("n_name").alias("name")),
        **_units(spark, folder),
    }
    return X.schedule_view(tables, as_of=FLOOR)


STORED_BEFORE = date(1999, 1, 1)


def _visit_tables(spark, folder):
    """Orders as visits, customers as patients and as the places visited."""
    customer = table(spark, folder, "customer")
    return {
        "visits": table(spark, folder, "orders").select(
            F.col("o_orderkey").cast("string").alias("tap_number"),
            F.col("o_orderdate").alias("visited_at"),
            (F.col("o_orderstatus") != "P").cast("int").alias("is_closed"),
            F.col("o_custkey").alias("patient_id"),
            F.col("o_custkey").alias("resource_id"),
        ),
        "patients": customer.select(
            F.col("c_custkey").alias("patient_id"),
            F.concat(F.lit("M"), F.col("c_custkey").cast("string")).alias("card_number"),
            F.col("c_name").alias("last_name"),
            F.col("c_mktsegment").alias("first_name"),
            F.when(F.col("c_nationkey") != 7, F.lit("Петрович")).alias("middle_name"),
            F.make_date(F.lit(1930) + F.col("c_nationkey") * 2, F.lit(3), F.lit(1)).alias("birth_date"),
        ),
        "resources": customer.select(F.col("c_custkey").alias("resource_id"), F.col("c_nationkey").alias("department_id")),
        **_units(spark, folder),
    }


def star_visits(spark, folder):
    return X.visits_view(_visit_tables(spark, folder), since=FLOOR)


def star_cards(spark, folder):
    """Line items as check-up cards, suppliers as resources and doctors."""
    flag = F.col("l_returnflag")
    tables = {
        "cards": table(spark, folder, "lineitem").select(
            F.date_sub(F.col("l_shipdate").cast("date"), 10).alias("date_open"),
            F.col("l_shipdate").alias("date_close"),
            F.col("l_orderkey").cast("string").alias("card_number"),
            (F.col("l_linenumber") < 7).cast("int").alias("is_closed"),
            F.when(F.col("l_linestatus") == "F", REASON).alias("close_reason_guid"),
            F.when(flag == "A", F.lit(KINDS[0].upper())).when(flag == "N", KINDS[1]).otherwise("other").alias("card_type_guid"),
            F.col("l_suppkey").alias("resource_id"),
        ),
        "resources": table(spark, folder, "supplier").select(
            F.col("s_suppkey").alias("resource_id"), F.col("s_suppkey").alias("doctor_id"), F.col("s_nationkey").alias("department_id")
        ),
        "doctors": _doctors(spark, folder),
        **_units(spark, folder),
    }
    return X.cards_view(tables, since=FLOOR, until=AS_OF, reason=REASON, card_types=KINDS)


def access_flag_sums(spark, folder):
    flags = access_flags(_code())
    return table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        *[F.sum(flag.cast("long")).alias(name) for name, flag in flags.items()]
    )


def recency_bands(spark, folder):
    """Customers as followed-up patients with their latest closed visits."""
    visits = X.patient_visits(_visit_tables(spark, folder), since=FLOOR, latest_only=True)
    patients = table(spark, folder, "customer").select(
        F.lit(77).cast("long").alias("org_id"),
        F.concat(F.lit("Поликлиника ОСП "), F.col("c_nationkey").cast("string")).alias("unit"),
        F.upper("c_name").alias("last_name"),
        F.left("c_mktsegment", F.lit(1)).alias("first_name"),
        F.when(F.col("c_nationkey") != 7, F.lit("П")).alias("middle_name"),
        (F.lit(1930) + F.col("c_nationkey") * 2).alias("birth_year"),
        (F.lit(71) - F.col("c_nationkey") * 2).alias("age"),
    )
    return V.recency(patients, visits, org_id=77, as_of=AS_OF)


def latest_visits_refreshed(spark, folder):
    """Latest visits stored before the last years, when open visits still counted, brought up to date by what changed."""
    stage_folder(spark)
    tables = _visit_tables(spark, folder)
    now = X.patient_visits(tables, since=FLOOR)
    with_open = X.patient_visits({**tables, "visits": tables["visits"].withColumn("is_closed", F.lit(1))}, since=FLOOR)
    then = with_open.where(F.col("tap_date") < F.lit(STORED_BEFORE))
    columns = [*V.PERSON, "tap_number", "tap_date"]
    then, now = (df.select(*columns).withColumn("birth_year", F.col("birth_year").try_cast("int")) for df in (then, now))
    return refreshed_latest(
        cut_lineage(V.latest_visits(then)), now, now.where(F.col("tap_date") >= F.lit(STORED_BEFORE)),
        rows_without(then, now, ["tap_number"]), person=V.PERSON, key="tap_number", latest=V.latest_visits,
    ).select(*columns)


QUERIES = {
    "latest_visits_refreshed": latest_visits_refreshed,
    "star_schedule": star_schedule,
    "star_visits": star_visits,
    "star_cards": star_cards,
    "access_flags": access_flag_sums,
    "recency_bands": recency_bands,
}

_CODE_SQL = "CAST(CAST(l_quantity AS INTEGER) + l_linenumber * 11 AS INTEGER)"
_BITS = {"ac_registrar": 1, "ac_doctor": 2, "ac_internet": 4, "ac_other_mo": 8, "ac_infomat": 32, "ac_call_center": 64}
_DOCTOR_SQL = "upper(s_name || ' ' || 'n' || s_nationkey || ' ' || CASE WHEN s_acctbal >= 0 THEN 'Иванович' END)"
_VISITS_SQL = f"""visits AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS tap_number, CAST(o_orderdate AS DATE) AS tap_date, 'M' || c_custkey AS mkab_number,
           upper(c_name) AS last_name, left(c_mktsegment, 1) AS first_name, CASE WHEN c_nationkey <> 7 THEN 'П' END AS middle_name,
           CAST(1930 + c_nationkey * 2 AS VARCHAR) AS birth_year, n_name AS department_name, r_name AS subdivision_name
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey
    WHERE o_orderdate >= TIMESTAMP '{FLOOR} 00:00:00' AND o_orderstatus <> 'P')"""

ORACLES = {
    "latest_visits_refreshed": f"""WITH {_VISITS_SQL}
        SELECT last_name, first_name, middle_name, CAST(birth_year AS INTEGER) AS birth_year, tap_number, tap_date
        FROM visits QUALIFY row_number() OVER (
            PARTITION BY last_name, first_name, middle_name, birth_year ORDER BY tap_date DESC, tap_number DESC) = 1""",
    "star_schedule": f"""SELECT l_partkey AS resource_id, l_shipdate AS begin_time, l_shipdate + INTERVAL 15 MINUTE AS end_time,
        rt.r_name AS resource_type, {_DOCTOR_SQL} AS doctor_full_name, 'eq ' || eq.n_name AS equipment_name,
        et.r_name AS equipment_type, rm.n_name AS cabinet_number, bt.r_name AS cell_type, {_CODE_SQL} AS access_code,
        CAST(l_returnflag = 'R' AS INTEGER) AS is_used, CAST(l_linestatus = 'O' AS INTEGER) AS is_out_schedule,
        sp.n_nationkey AS specialty_id, sp.n_name AS specialty_name, dep.n_name AS department_name, sub.r_name AS subdivision_name,
        {", ".join(f"CASE WHEN {_CODE_SQL} & {bit} > 0 THEN 1 ELSE 0 END AS {name}" for name, bit in _BITS.items())}
        FROM lineitem LEFT JOIN region bt ON bt.r_regionkey = l_linenumber LEFT JOIN supplier ON s_suppkey = l_suppkey
        LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN region rt ON rt.r_regionkey = p_size // 10
        LEFT JOIN nation eq ON eq.n_nationkey = p_size LEFT JOIN region et ON et.r_regionkey = eq.n_regionkey
        LEFT JOIN nation rm ON rm.n_nationkey = p_size // 2 LEFT JOIN nation sp ON sp.n_nationkey = p_size
        LEFT JOIN nation dep ON dep.n_nationkey = p_size // 2 LEFT JOIN region sub ON sub.r_regionkey = dep.n_regionkey
        WHERE CAST(l_shipdate AS DATE) >= DATE '{FLOOR}' AND p_size > 5""",
    "star_visits": f"WITH {_VISITS_SQL} SELECT * FROM visits",
    "star_cards": f"""SELECT CAST(l_shipdate AS DATE) - 10 AS date_open, l_shipdate AS date_close, CAST(l_orderkey AS VARCHAR) AS card_number,
        r_name AS subdivision_name, {_DOCTOR_SQL} AS doctor_full_name
        FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey
        LEFT JOIN region ON r_regionkey = n_regionkey
        WHERE l_shipdate >= TIMESTAMP '{FLOOR} 00:00:00' AND l_shipdate <= TIMESTAMP '{AS_OF} 00:00:00'
          AND l_linenumber < 7 AND l_linestatus = 'F' AND l_returnflag IN ('A', 'N')""",
    "access_flags": f"""SELECT l_suppkey, {", ".join(
        f"CAST(sum(CASE WHEN {_CODE_SQL} & {bit} > 0 THEN 1 ELSE 0 END) AS BIGINT) AS {name}" for name, bit in _BITS.items())}
        FROM lineitem GROUP BY l_suppkey""",
    "recency_bands": f"""WITH {_VISITS_SQL},
        latest AS (SELECT * FROM visits QUALIFY row_number() OVER (
            PARTITION BY last_name, first_name, middle_name, birth_year ORDER BY tap_date DESC, tap_number DESC) = 1),
        people AS (SELECT 'Поликлиника ОСП ' || c_nationkey AS department, left('ОСП ' || c_nationkey, 5) AS subdivision,
            upper(c_name) AS last_name, left(c_mktsegment, 1) AS first_name, CASE WHEN c_nationkey <> 7 THEN 'П' END AS middle_name,
            CAST(1930 + c_nationkey * 2 AS INTEGER) AS birth_year, CAST(71 - c_nationkey * 2 AS INTEGER) AS age FROM customer)
        SELECT p.subdivision, p.department, l.mkab_number, p.last_name, p.first_name, p.middle_name, p.birth_year, p.age, l.tap_date,
               CASE WHEN date_diff('day', l.tap_date, DATE '{AS_OF}') >= 30 THEN 'red'
                    WHEN date_diff('day', l.tap_date, DATE '{AS_OF}') >= 20 THEN 'yellow' ELSE '' END AS band
        FROM people p LEFT JOIN latest l ON l.last_name IS NOT DISTINCT FROM p.last_name
          AND l.first_name IS NOT DISTINCT FROM p.first_name AND l.middle_name IS NOT DISTINCT FROM p.middle_name
          AND CAST(l.birth_year AS INTEGER) IS NOT DISTINCT FROM p.birth_year""",
}
