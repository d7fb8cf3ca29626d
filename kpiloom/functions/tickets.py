"""Support-ticket text: spelling, number, tags and rich text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions.text import Rules


def unify_spelling(text: Column) -> Column:
    """All spellings replaced, in their fixed order."""
    return reduce(lambda done, pair: F.replace(done, F.lit(pair[0]), F.lit(pair[1])), fv.TICKET_SPELLINGS, text)


def ticket_digits(text: Column) -> Column:
    """Digits of the ticket number, empty where there is none."""
    return F.regexp_extract(text, fv.TICKET_NUMBER, 1)


def _tags(text: Column, rules: Rules) -> Column:
    return F.array_compact(F.array(*[F.when(text.contains(tag), label) for tag, label in rules]))


def groups(text: Column) -> Column:
    """Site tags in text order, repeats kept, then the other group tags."""
    sites = F.regexp_extract_all(text, F.lit(fv.TICKET_SITE_TAG), F.lit(1))
    return F.concat(sites, _tags(text, fv.TICKET_GROUP_TAGS))


def themes(text: Column) -> Column:
    return _tags(text, fv.TICKET_THEME_TAGS)


def status(text: Column) -> Column:
    return F.when(text.contains(fv.TICKET_SOLVED_TAG), fv.TICKET_SOLVED).otherwise(fv.TICKET_OPEN)


def listed(items: Column) -> Column:
    return F.array_join(items, ", ")


def plain_text(content: Column) -> Column:
    """Text of a message whose content is a string or a list of strings and objects."""
    parts = F.try_variant_get(content, "$", "array<variant>")
    joined = F.array_join(
        F.transform(
            parts,
            lambda part: F.coalesce(
                F.try_variant_get(part, "$.text", "string"),
                F.try_variant_get(part, "$", "string"),
            ),
        ),
        "",
    )
    return F.replace(F.coalesce(joined, F.try_variant_get(content, "$", "string")), F.lit("\n"), F.lit(" "))
