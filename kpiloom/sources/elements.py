"""Elements of an array in a JSON document of any layout, read in splits.

A document on one line has no line ends to split at, so it is read in pieces that
end at closing braces.  Whether a brace is part of a string, and at which depth
it stands, depends on all of the document before it: every piece first says how
many quotes it has, and, once it knows whether it starts inside a string, by how
much it changes the depth.  Both are summed over the pieces of a block and over
the blocks of a file, which gives the bounds of the elements; only the pieces of
an element that has several are then brought together.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators.lineage import cut_lineage
from kpiloom.operators.running import before
from kpiloom.sources.lines import placed_lines


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\.", "")


def _depth_change(text: Column, inside: Column) -> Column:
    """Braces and brackets opened less those closed, outside strings, in a text without escapes."""
    behind = F.when(F.contains(text, F.lit('"')), F.regexp_replace(text, r'^[^"]*+"', "")).otherwise("")
    plain = F.when(inside, behind).otherwise(text)
    plain = F.regexp_replace(F.regexp_replace(plain, r'"[^"]*+"', ""), r'"[^"]*+$', "")
    return (_count(plain, "{") + _count(plain, "[") - _count(plain, "]") - _count(plain, "}")).cast("long")


def _pieces(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Pieces up to a closing brace: value, source_file, block, place, inside (a string), depth, depth_after, open (a string at the end)."""
    pieces = placed_lines(spark, paths, line_end="}")
    pieces = pieces.withColumn("odd", (_count(_unescaped(F.col("value")), '"') % 2).cast("long"))
    pieces = before(pieces, ["source_file"], "block", ["place"], "odd", 2, "quotes")
    pieces = pieces.withColumn("inside", F.col("quotes") % 2 == 1).withColumn("open", (F.col("quotes") + F.col("odd")) % 2 == 1)
    change = _depth_change(_unescaped(F.col("value")), F.col("inside")) - F.when(F.col("open"), 0).otherwise(1)
    pieces = pieces.withColumn("change", change).drop("odd", "quotes")
    pieces = before(pieces, ["source_file"], "block", ["place"], "change", 2, "depth")
    return cut_lineage(pieces.withColumn("depth_after", F.col("depth") + F.col("change")).drop("change"))


def array_elements(spark: SparkSession, paths: str | Sequence[str], field: str) -> DataFrame:
    """``source_file, number, value``: the objects of the array under the top-level ``field`` of each document, as text.

    ``number`` counts from 0 in each document.  A document without that array,
    or with an empty one, has no rows.  The elements must be objects.
    """
    pieces = _pieces(spark, paths)
    at = F.struct("block", "place")
    opening = rf'"{re.escape(field)}"\s*+:\s*+\['
    heads = pieces.where(F.regexp_like("value", F.lit(opening)))
    ahead = F.substr("value", F.lit(1), F.regexp_instr("value", F.lit(opening)) - 1)
    key_depth = F.col("depth") + _depth_change(_unescaped(ahead), F.col("inside"))
    heads = heads.where(key_depth == 1).groupBy("source_file").agg(F.min(at).alias("_opens"))
    known = pieces.join(heads, "source_file").where(at >= F.col("_opens"))
    is_head = at == F.col("_opens")
    # The first piece loses what precedes the array.
    text = F.when(is_head, F.regexp_replace("value", rf"(?s)^.*?{opening}", "")).otherwise(F.col("value"))
    first = is_head | ((F.col("depth") == 2) & ~F.col("inside"))
    known = known.withColumns({"text": text, "starts": first})
    closes = F.col("starts") & F.startswith(F.ltrim(F.regexp_replace("text", r"\s++", " ")), F.lit("]"))
    ends = known.where(closes).groupBy("source_file").agg(F.min(at).alias("_closes"))
    known = known.join(ends.withColumnRenamed("source_file", "_file"), F.col("source_file") == F.col("_file"), "left")
    known = known.where(F.col("_closes").isNull() | (at < F.col("_closes")))
    known = known.withColumn("ends", (~F.col("open") & (F.col("depth_after") == 2)).cast("long"))
    known = before(known, ["source_file"], "block", ["place"], "ends", 2, "number")
    known = cut_lineage(known.select("source_file", "number", "block", "place", "text", "starts", "ends"))
    whole = known.where("starts AND ends = 1").select("source_file", "number", F.col("text").alias("value"))
    parts = known.where("NOT (starts AND ends = 1)").groupBy("source_file", "number")
    parts = parts.agg(F.sort_array(F.collect_list(F.struct("block", "place", "text"))).alias("parts"), F.max("ends").alias("ended"))
    joined = parts.where("ended = 1").select("source_file", "number", F.array_join("parts.text", "}").alias("value"))
    value = F.concat(F.regexp_replace("value", r"^[\s,]++", ""), F.lit("}"))
    return whole.unionByName(joined).withColumn("value", value)
