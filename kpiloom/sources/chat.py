"""Chat exports: one JSON document with an array of messages."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom import fixed_values as fv
from kpiloom.schemas import CHAT_EXPORT, CHAT_MESSAGE
from kpiloom.sources.elements import array_elements
from kpiloom.sources.files import Newest, source_paths
from kpiloom.sources.lines import placed_lines, without_ends

# Lines at the start of an export among which its layout must show.
HEAD_LINES = 500


def chat_messages(spark: SparkSession, path: str, *, intro: int = fv.TICKET_INTRO_RECORDS) -> DataFrame:
    """Messages after the introductory records of each document: id, author, text (variant).

    A document is parsed by one task; fields outside the schema are skipped
    while parsing.  For large exports see `split_chat_messages`.
    """
    documents = spark.read.schema(CHAT_EXPORT).option("multiLine", True).json(path)
    messages = documents.select(F.posexplode("messages").alias("pos", "message"))
    return messages.where(F.col("pos") >= intro).select("message.*")


def indented_chat_messages(
    spark: SparkSession, path: str, *, indent: int = 2, intro: int = fv.TICKET_INTRO_RECORDS
) -> DataFrame:
    """The same for exports written with one indented block per message, read in parallel.

    A message starts with a line of ``indent`` spaces and an opening brace and
    ends with the closing brace at the same depth; neither can occur inside a
    JSON string, where line breaks are escaped.  The file is split at those
    lines, so its size does not matter.
    """
    margin = "\n" + " " * indent
    blocks = placed_lines(spark, path, line_end=margin + "{\n")
    # The first block is what precedes the first message.
    messages = without_ends(blocks, top=range(intro + 1))
    body = F.substring_index("value", margin + "}", 1)
    message = F.from_json(F.concat(F.lit("{"), body, F.lit("}")), CHAT_MESSAGE)
    return messages.select(message.alias("message")).select("message.*")


def split_chat_messages(spark: SparkSession, path: str, *, intro: int = fv.TICKET_INTRO_RECORDS) -> DataFrame:
    """The same for documents of any layout, such as one long line, each read in parallel."""
    messages = array_elements(spark, path, "messages").where(F.col("number") >= intro)
    return messages.select(F.from_json("value", CHAT_MESSAGE).alias("message")).select("message.*")


def message_indent(spark: SparkSession, path: str) -> int | None:
    """Spaces before each message of an export with one block per message, or None for another layout.

    Only the first lines are looked at, and of each only its start and end.
    """
    start, end = F.substring("value", 1, 100), F.substring("value", -100, 100)
    head = spark.read.text(path).select(start.alias("start"), end.alias("end")).limit(HEAD_LINES).collect()
    margin = re.match(r" *", head[1]["start"]).group() if len(head) > 1 else ""  # of the document's own fields
    for line, following in zip(head, head[1:]):
        if not re.match(margin + r'"messages"', line["start"]):
            continue
        if re.search(r'"messages"\s*:\s*\[$', line["end"].rstrip()) and re.fullmatch(r" +\{", following["start"].rstrip()):
            return len(following["start"].rstrip()) - 1
    return None


def exported_messages(spark: SparkSession, path: str | Newest, *, intro: int = fv.TICKET_INTRO_RECORDS) -> DataFrame:
    """Messages of an export, or of the newest one of a folder, whatever its layout.

    Every document is read in parallel.  An export with one indented block per
    message is split at those; its blocks must include the messages, else the
    layout was misread and an error is raised.
    """
    path = source_paths(spark, path)
    indent = message_indent(spark, path) if _is_one_file(spark, path) else None
    if indent is None:
        return split_chat_messages(spark, path, intro=intro)
    margin = "\n" + " " * indent + "{\n"
    if len(spark.read.option("lineSep", margin).text(path).select(F.lit(1)).limit(2).collect()) < 2:
        raise ValueError(f"no message found in {path} with an indent of {indent}")
    return indented_chat_messages(spark, path, indent=indent, intro=intro)


def _is_one_file(spark: SparkSession, path: str) -> bool:
    return len(spark.read.format("binaryFile").load(path).select("path").limit(2).collect()) == 1
