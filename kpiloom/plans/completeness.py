"""Admission department: are examination, referral and examination time recorded?"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom import fixed_values as fv
from kpiloom.functions.numbers import half_even, percent
from kpiloom.functions.text import site_suffix, yes_no
from kpiloom.operators.joins import null_safe_join
from kpiloom.operators.rows import any_of, differs, holds, present
from kpiloom.operators.running import before
from kpiloom.sources.config import config_table

# Ranges of a minute that running sums over parts of minutes go by.
PARTS_OF_MINUTE = 1024

CHECKS = ("exam_done", "referral_done", "time_correct")


def _recorded() -> dict[str, Column]:
    return {
        "exam_done": F.col("exam_time").isNotNull(),
        "referral_done": any_of([F.col(name).isNotNull() for name in ("lab_ref", "ecg_ref", "instr_ref")]),
    }


def _limit() -> Column:
    return F.when(F.col("state_on_admission") == fv.STATE_SATISFACTORY, fv.EXAM_LIMIT_SATISFACTORY).otherwise(
        fv.EXAM_LIMIT_OTHER
    )


# No limit is longer, so longer stays need not be told apart; shorter than 0 is one class.
_LONGEST = max(fv.EXAM_LIMIT_SATISFACTORY, fv.EXAM_LIMIT_OTHER)


def _minute(value: Column) -> Column:
    """The whole minute of a value, from -1 for less than none to one above the longest limit."""
    return F.greatest(F.lit(-1), F.least(F.floor(value), F.lit(_LONGEST + 1))).cast("int")


def _stays(times: DataFrame) -> DataFrame:
    """Rows, sum and number of stays per card and profile, and how many stays lie in each whole minute.

    Rows are counted per minute first: of a card on very many rows no more than
    a row per minute and task is shuffled, and what is collected has at most as
    many entries as there are minutes.
    """
    stay = F.col("stay_minutes")
    keys = ["card_number", "profile_unit"]
    by_minute = times.groupBy(*keys, _minute(stay).alias("minute")).agg(
        F.count(F.lit(1)).alias("copies"), F.sum(stay).alias("stay_sum"), F.count(stay).alias("stays")
    )
    entry = F.when(F.col("stays") > 0, F.struct("minute", F.col("stays").alias("n")))
    return by_minute.groupBy(*keys).agg(
        F.sum("copies").alias("copies"), F.sum("stay_sum").alias("stay_sum"), F.sum("stays").alias("stays"),
        F.collect_list(entry).alias("by_minute"),
    )


def _whole(df: DataFrame, name: str) -> bool:
    """Whether the type of a column holds whole numbers only."""
    kind = df.schema[name].dataType
    return isinstance(kind, T.IntegralType) or (isinstance(kind, T.DecimalType) and kind.scale == 0)


def _in_same_minute(admissions: DataFrame, times: DataFrame) -> DataFrame:
    """Stays longer than an examination's minutes within the same whole minute, where stays have parts of minutes.

    Both are put in one order per card, profile and minute, and counted by
    running sums over parts of the minute, so that a card on very many rows is
    no single running sum.
    """
    stay = F.col("stay_minutes")
    parts = times.where((stay <= _LONGEST + 1) & ((stay != F.floor(stay)) | (stay < 0)))
    keys = ["card_number", "profile_unit"]
    longer = parts.groupBy(*keys, stay.cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    minutes = F.col("minutes_to_exam")
    asked = admissions.where(minutes <= _LONGEST).select("card_number", minutes.cast("double").alias("value")).distinct()
    profiles = longer.select(*keys).distinct()
    probes = null_safe_join(profiles, asked, ["card_number"], how="inner").withColumn("n", F.lit(0).cast("long"))
    both = longer.unionByName(probes).withColumn("minute", _minute(F.col("value")))
    # The longest first, so that the rows before a probe are the longer stays; at equal values the probe comes first.
    part = F.floor((F.col("minute") + 1 - F.col("value")) * PARTS_OF_MINUTE)
    both = both.withColumn("part", F.least(F.lit(PARTS_OF_MINUTE - 1), F.greatest(F.lit(0), part)))
    counted = before(both, [*keys, "minute"], "part", [F.desc("value"), F.asc("n")], "n", PARTS_OF_MINUTE, "within")
    return counted.where("n = 0").select(*keys, F.col("value").alias("_minutes"), "within")


def flag_admissions(admissions: DataFrame, times: DataFrame, *, main_site: str) -> DataFrame:
    """Every admission once per profile unit of its card in the time report, with the site and the checks.

    A row stands for ``copies`` joined rows, of which ``on_time`` pass the
    third check.  The time report is counted per card and profile before the
    join, so a card number (or a missing one) on very many rows of both sides
    never produces its pairs.  An admission without times stands for one row.
    """
    joined = null_safe_join(admissions, _stays(times), ["card_number"])
    minutes = F.col("minutes_to_exam")
    joined = joined.where(differs(F.col("profile_unit"), fv.PROFILE_EXCLUDED)).withColumn("_minutes", minutes.cast("double"))
    in_minutes = F.filter("by_minute", lambda entry: entry["minute"] > _minute(minutes))
    longer = F.aggregate(in_minutes, F.lit(0).cast("long"), lambda total, entry: total + entry["n"])
    if not (_whole(times, "stay_minutes") and _whole(admissions, "minutes_to_exam")):
        joined = null_safe_join(joined, _in_same_minute(admissions, times), ["card_number", "profile_unit", "_minutes"])
        longer = longer + F.coalesce("within", F.lit(0))
    on_time = F.when(holds(minutes <= _limit()), F.coalesce(longer, F.lit(0))).otherwise(0).cast("long")
    return joined.withColumns(
        {
            **_recorded(),
            "on_time": on_time,
            "copies": F.coalesce("copies", F.lit(1)),
            "site": site_suffix(F.col("admission_unit"), main_site),
        }
    ).drop("by_minute", "within", "_minutes")


def _of_site(df: DataFrame, main_site: str, main: bool) -> DataFrame:
    site = site_suffix(F.col("admission_unit"), main_site)
    return df.where(site == main_site) if main else df.where(site != main_site)


def completeness(
    admissions: DataFrame,
    times: DataFrame,
    *,
    main_site: str,
    main: bool = True,
    unit_labels: Mapping[str, str] | None = None,
) -> DataFrame:
    """Patients and rates of the three checks per doctor and unit, see `rates`."""
    flagged = flag_admissions(admissions, times, main_site=main_site)
    return rates(flagged, main_site=main_site, main=main, unit_labels=unit_labels)


def rates(
    flagged: DataFrame, *, main_site: str, main: bool = True, unit_labels: Mapping[str, str] | None = None
) -> DataFrame:
    """Patients and rates of the three checks per doctor and unit, of admissions with their checks.

    Of the main site the unit is not shown, so a doctor may have several rows;
    of the other sites it is shown by its short label, null without one.
    """
    rows = _of_site(flagged, main_site, main)
    patients = F.sum(F.when(F.col("patient_name").isNotNull(), F.col("copies")).otherwise(0))
    passed = {name: F.sum(F.when(F.col(name), F.col("copies")).otherwise(0)) for name in _recorded()}
    passed["time_correct"] = F.sum("on_time")
    by_doctor = (
        rows.where(present(["doctor_name", "admission_unit"]))
        .groupBy("doctor_name", "admission_unit")
        .agg(patients.alias("patients"), *[total.alias(name) for name, total in passed.items()])
    )
    shares = [percent(F.col(name), F.col("patients")).cast("long").alias(f"{name}_pct") for name in CHECKS]
    if main:
        return by_doctor.select("doctor_name", "patients", *shares)
    labelled = _labelled(by_doctor, unit_labels or {})
    return labelled.select("doctor_name", "unit_label", "patients", *shares)


def _labelled(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    table = config_table(df.sparkSession, labels, "admission_unit STRING, unit_label STRING")
    return df.join(table, "admission_unit", "left")


def violations(flagged: DataFrame) -> DataFrame:
    """Admissions failing any check, with the checks in words.

    Equal rows are one row with their number in ``copies``.  Written one
    folder per ``admission_unit`` and ordered by doctor by the sink.
    """
    parts = F.array(
        F.struct(F.lit(True).alias("time_correct"), F.col("on_time").alias("copies")),
        F.struct(F.lit(False).alias("time_correct"), (F.col("copies") - F.col("on_time")).alias("copies")),
    )
    told_apart = flagged.withColumn("part", F.explode(parts)).where("part.copies > 0")
    told_apart = told_apart.withColumns({"time_correct": F.col("part.time_correct"), "copies": F.col("part.copies")})
    shown = [
        "admission_unit", "card_number", "patient_name", "admit_date", "doctor_name", "diagnosis", "profile_unit", "site",
    ]
    listed = told_apart.where(any_of([~F.col(name) for name in CHECKS]))
    return listed.groupBy(*shown, *[yes_no(F.col(name)).alias(name) for name in CHECKS]).agg(F.sum("copies").alias("copies"))


def mean_stay(admissions: DataFrame, times: DataFrame, *, main_site: str, main: bool = True) -> DataFrame:
    """Mean stay in whole minutes per unit, rows without a stay left out of the mean."""
    joined = null_safe_join(admissions.select("card_number", "admission_unit"), _stays(times), ["card_number"])
    rows = _of_site(joined.where(differs(F.col("profile_unit"), fv.PROFILE_EXCLUDED)), main_site, main)
    mean = F.try_divide(F.sum("stay_sum"), F.sum("stays"))
    by_unit = rows.where(present(["admission_unit"])).groupBy("admission_unit")
    return by_unit.agg(half_even(mean).cast("long").alias("mean_stay"))
