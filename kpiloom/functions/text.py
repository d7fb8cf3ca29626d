"""Unit names, person names and text repair as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom import fixed_values as fv

Rules = Sequence[tuple[str, str]]


def first_match(value: Column, rules: Rules) -> Column:
    """Label of the first rule whose word occurs in ``value``; null without a match."""
    return F.coalesce(F.lit(None).cast("string"), *[F.when(value.contains(word), label) for word, label in rules])


def site_suffix(unit: Column, main_site: str) -> Column:
    """Site of a unit whose name ends in a site code, else the main site."""
    return F.when(unit.rlike(fv.SITE_AT_END), F.regexp_extract(unit, fv.SITE_CODE, 0)).otherwise(main_site)


def site_prefix(unit: Column, main_site: str) -> Column:
    """Site of a unit whose name starts with a site code, else the main site."""
    return F.when(unit.rlike(fv.SITE_AT_START), F.regexp_extract(unit, fv.SITE_CODE, 0)).otherwise(main_site)


def department(unit: Column) -> Column:
    """Department of a unit name: site code, site word, or the name itself."""
    code = F.when(unit.rlike(fv.SITE_ANYWHERE), F.regexp_extract(unit, fv.SITE_CODE_NUMBERED, 0))
    return F.coalesce(code, first_match(unit, fv.SITE_WORDS), unit, F.lit(fv.SITE_UNKNOWN))


def current_unit(unit: Column, rules: Rules) -> Column:
    """Former unit names mapped to current ones by ordered rules, others unchanged."""
    return F.coalesce(first_match(unit, rules), unit)


def booking_name(value: Column) -> Column:
    """Upper-case person name from ``<code> <name> <name> <name>, ...``.

    Null for a null or a text of fewer than four words.
    """
    words = F.split(value, " ")
    name = F.concat_ws(" ", F.get(words, 1), F.get(words, 2), F.replace(F.get(words, 3), F.lit(",")))
    return F.when(F.size(words) >= 4, F.upper(name))


def full_name(*parts: Column) -> Column:
    """Upper-case parts joined by a space; null when any part is null."""
    spaced = [piece for part in parts for piece in (F.lit(" "), part)][1:]
    return F.upper(F.concat(*spaced))


def yes_no(flag: Column) -> Column:
    return F.when(flag, fv.YES).otherwise(fv.NO)


def stacked(value: Column) -> Column:
    """One word per line, for narrow display columns."""
    return F.replace(value, F.lit(" "), F.lit("\n"))


def _high_half(encoding: str) -> str:
    codes = (code for code in range(0x80, 0x100) if code != 0x98)  # cp1251 has no character 0x98
    return bytes(codes).decode(encoding)


def repair_cp1251(value: Column) -> Column:
    """Text whose cp1251 bytes were read as latin1, put right."""
    return F.translate(value, _high_half("latin1"), _high_half("cp1251"))


def repair_strings(df: DataFrame) -> DataFrame:
    """`repair_cp1251` on every string column."""
    names = [field.name for field in df.schema.fields if isinstance(field.dataType, T.StringType)]
    return df.withColumns({name: repair_cp1251(F.col(name)) for name in names})
