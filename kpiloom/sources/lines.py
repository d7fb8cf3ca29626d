"""Records of text files with their place, and files without their first and last records."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.operators.lineage import cut_lineage


def placed_lines(
    spark: SparkSession, paths: str | Sequence[str], *, name_part: str = "", line_end: str | None = None
) -> DataFrame:
    """Records of all files: value, source_file, block, place.

    Files are read as splittable text; inside a file, records are ordered by the
    start of their block and by their place in the task that reads it.  They are
    stored once, because a reader looks at them twice and both times must see
    the same places.
    """
    reader = spark.read.option("pathGlobFilter", f"*{name_part}*")
    if line_end is not None:
        reader = reader.option("lineSep", line_end)
    return cut_lineage(
        reader.text(paths).select(
            "value",
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
        )
    )


def without_ends(lines: DataFrame, *, top: Collection[int] = (), footer: int = 0) -> DataFrame:
    """Lines but for those numbered ``top`` (from 0) and the last ``footer`` of each file.

    The ends of a file are found with a limit in each task, so no file passes
    through one task, and only they are compared with all lines.
    """
    places = lines.select("source_file", "block", "place")
    per_file = Window.partitionBy("source_file")
    body = lines
    if top:
        number = F.row_number().over(per_file.orderBy("block", "place"))
        head = places.withColumn("line", number).where(F.col("line") <= max(top) + 1)
        wanted = head.where((F.col("line") - 1).isin(list(top))).select("source_file", "place")
        body = body.join(wanted, ["source_file", "place"], "left_anti")
    if footer:
        number = F.row_number().over(per_file.orderBy(F.desc("block"), F.desc("place")))
        tail = places.withColumn("line", number).where(F.col("line") <= footer).select("source_file", "place")
        body = body.join(tail, ["source_file", "place"], "left_anti")
    return body


def only_line(lines: DataFrame, number: int) -> DataFrame:
    """The line with this number (from 0) of each file."""
    order = Window.partitionBy("source_file").orderBy("block", "place")
    numbered = lines.withColumn("line", F.row_number().over(order))
    return numbered.where(F.col("line") <= number + 1).where(F.col("line") == number + 1).drop("line")
