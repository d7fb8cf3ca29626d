"""Name and text functions on texts derived from ``customer`` and ``supplier``."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.bindings.inputs import labels, labels_sql, stage_folder, table
from kpiloom.functions import text as X
from kpiloom.operators.joins import tagged_union
from kpiloom.operators.rows import sorted_report
from kpiloom.operators.running import positions

UNITS = (
    "Поликлиника ОСП №3 каб. ", "ОСП 2 отделение ", "ЦАОП зал ", "п-ка Ленинградская ", "Централизованное отделение ", None, "Лаборатория ",
    "Стационар ОСП 1, ОСП ",
)
MAIN_SITE = "Главный корпус"
LEGACY = (("Старая больница", "ОСП 6"), ("ГБ №2", "ОСП 5"), ("больница", "ОСП 4"))
LEGACY_NAMES = ("Старая больница им. ", "Филиал ГБ №2 ", "Сельская больница ", "ОСП 1 ", None)
NAMES = ("№{} Альфа Бета Гамма, 1.1.1990", "№{} альфа бета гамма", "№{} Альфа Бета", None, "№{} Альфа Бета Гам,ма, прим. 2")
GARBLED = ("Ïðèâåò ", "Îòäåëåíèå ¹", "plain ", "¸æ ")
REPAIRED = ("Привет ", "Отделение №", "plain ", "ёж ")


def _by_nation(options):
    """The options in turn for the 25 nation keys."""
    return {nation: options[nation % len(options)] for nation in range(25)}


def _customers(spark, folder, options, name):
    nation = F.col("c_nationkey")
    value = F.concat(labels(nation, _by_nation(options)), nation.cast("string"))
    return table(spark, folder, "customer").select("c_custkey", value.alias(name))


def unit_normalize(spark, folder):
    return _customers(spark, folder, UNITS, "unit").withColumn("department", X.department(F.col("unit")))


def site_from_unit(spark, folder):
    return _customers(spark, folder, UNITS, "unit").withColumns(
        {
            "site_at_end": X.site_suffix(F.col("unit"), MAIN_SITE),
            "site_at_start": X.site_prefix(F.col("unit"), MAIN_SITE),
        }
    )


def legacy_unit_map(spark, folder):
    return _customers(spark, folder, LEGACY_NAMES, "unit").withColumn("current", X.current_unit(F.col("unit"), LEGACY))


def name_normalize(spark, folder):
    written = F.replace(labels(F.col("c_nationkey"), _by_nation(NAMES)), F.lit("{}"), F.col("c_custkey").cast("string"))
    return table(spark, folder, "customer").select("c_custkey", X.booking_name(written).alias("patient_name"))


def encoding_repair(spark, folder):
    return X.repair_strings(_customers(spark, folder, GARBLED, "note"))


def source_union_tagged(spark, folder):
    return tagged_union(
        {
            "customer": table(spark, folder, "customer").select(
                F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")
            ),
            "supplier": table(spark, folder, "supplier").select(
                F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")
            ),
        },
        "unit",
    )


def sorted_suppliers(spark, folder):
    return sorted_report(table(spark, folder, "supplier"), "s_nationkey", "s_name")


def supplier_positions(spark, folder):
    """Every supplier's place in the sorted report."""
    stage_folder(spark)
    suppliers = table(spark, folder, "supplier").select("s_nationkey", "s_name", "s_suppkey")
    order = [F.asc_nulls_last(name) for name in suppliers.columns]
    return positions(suppliers, order, "place")


def narrow_names(spark, folder):
    """Priorities and their orders, one word per line."""
    unit = X.stacked(F.col("o_orderpriority")).alias("unit")
    return table(spark, folder, "orders").groupBy(unit).agg(F.count(F.lit(1)).alias("orders"))


QUERIES = {
    "sorted_report_positions": supplier_positions,
    "stacked_names": narrow_names,
    "unit_normalize": unit_normalize,
    "site_from_unit": site_from_unit,
    "legacy_unit_map": legacy_unit_map,
    "name_normalize": name_normalize,
    "encoding_repair": encoding_repair,
    "source_union_tagged": source_union_tagged,
    "sorted_report": sorted_suppliers,
}


def _derived(options, name):
    return f"(SELECT c_custkey, ({labels_sql('c_nationkey', _by_nation(options))}) || c_nationkey AS {name} FROM customer)"


ORACLES = {
    "sorted_report_positions": """SELECT s_nationkey, s_name, s_suppkey,
        row_number() OVER (ORDER BY s_nationkey NULLS LAST, s_name NULLS LAST, s_suppkey NULLS LAST) AS place FROM supplier""",
    "stacked_names": "SELECT replace(o_orderpriority, ' ', chr(10)) AS unit, count(*) AS orders FROM orders GROUP BY 1",
    "unit_normalize": f"""SELECT *, CASE WHEN regexp_matches(unit, 'ОСП №?[0-9]') THEN regexp_extract(unit, 'ОСП №?[0-9]', 0)
        WHEN unit LIKE '%ЦАОП%' THEN 'ЦАОП' WHEN unit LIKE '%Ленинградская%' OR unit LIKE '%Централизованное отделение%' THEN 'Ленинградская 9'
        WHEN unit IS NULL THEN 'Не указано' ELSE unit END AS department FROM {_derived(UNITS, "unit")}""",
    "site_from_unit": f"""SELECT *,
        CASE WHEN regexp_matches(unit, 'ОСП [0-9]$') THEN regexp_extract(unit, 'ОСП [0-9]', 0) ELSE '{MAIN_SITE}' END AS site_at_end,
        CASE WHEN regexp_matches(unit, '^ОСП [0-9]') THEN regexp_extract(unit, 'ОСП [0-9]', 0) ELSE '{MAIN_SITE}' END AS site_at_start
        FROM {_derived(UNITS, "unit")}""",
    "legacy_unit_map": f"""SELECT *, CASE WHEN contains(unit, 'Старая больница') THEN 'ОСП 6' WHEN contains(unit, 'ГБ №2') THEN 'ОСП 5'
        WHEN contains(unit, 'больница') THEN 'ОСП 4' ELSE unit END AS current FROM {_derived(LEGACY_NAMES, "unit")}""",
    "name_normalize": """SELECT c_custkey, CASE WHEN c_nationkey % 5 IN (0, 1, 4) THEN 'АЛЬФА БЕТА ГАММА' END AS patient_name FROM customer""",
    "encoding_repair": f"SELECT * FROM {_derived(REPAIRED, 'note')}",
    "source_union_tagged": """SELECT 'customer' AS unit, c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer
        UNION ALL SELECT 'supplier', s_name, s_nationkey, s_acctbal FROM supplier""",
    "sorted_report": "SELECT * FROM supplier",
}
