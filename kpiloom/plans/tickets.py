"""Support tickets out of chat messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.functions import tickets as T
from kpiloom.operators.aggregates import counts_by
from kpiloom.operators.rows import computed_once


def tickets(messages: DataFrame, *, link_base: str, rich_text: bool = True) -> DataFrame:
    """Tickets: messages with an author and a ticket number in their text.

    ``messages`` has id, author and text, the text as variant or, with
    ``rich_text`` off, as plain string.
    """
    content = T.plain_text(F.col("text")) if rich_text else F.replace("text", F.lit("\n"), F.lit(" "))
    spoken = messages.where(F.col("author").isNotNull()).select("id", "author", "text")
    # No spelling rule brings the word in, so messages without it are dropped before the rules run.
    named = computed_once(spoken, "text", content).where(F.col("text").contains(fv.TICKET_WORD))
    texts = computed_once(named, "text", T.unify_spelling(F.col("text")))
    numbered = computed_once(texts, "digits", T.ticket_digits(F.col("text")))
    return numbered.where(F.col("digits") != "").select(
        F.col("digits").try_cast("long").alias("number"),
        F.concat(F.lit(link_base), F.col("id").cast("string")).alias("url"),
        "author",
        T.status(F.col("text")).alias("status"),
        T.listed(T.groups(F.col("text"))).alias("group"),
        T.listed(T.themes(F.col("text"))).alias("theme"),
        "text",
    )


def ticket_status_counts(found: DataFrame) -> DataFrame:
    return counts_by(found, ["status"], "number", "tickets")


def open_by_group(found: DataFrame) -> DataFrame:
    """Open tickets per group text; a ticket of two groups is a group of its own."""
    return counts_by(found.where(F.col("status") == fv.TICKET_OPEN), ["group"], "number", "open_tickets")
