"""Records that span lines, from files read in splits.

A quoted field may hold line breaks, so where a record ends depends on the whole
file before it.  Files are read as splittable lines.  A line, whatever precedes
it, does one of four things to the state "inside a quoted field": it keeps it,
turns it, opens it or closes it.  These steps are composed inside each block of
a file and then over its blocks, so that every line learns the state it starts
in; only the lines of records over several lines are then brought together.
No file passes through one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.operators.lineage import cut_lineage
from kpiloom.operators.running import before
from kpiloom.sources.lines import placed_lines

# Characters of the longest record that is put together; a longer one is refused, as a quote is missing or astray.
RECORD_LENGTH = 64 * 2**20

# Where a quote finds the reader: at the start of a field, inside a quoted field, behind its closing quote, elsewhere.
_START, _INSIDE, _CLOSED, _ELSEWHERE = 0, 1, 2, 3


def _inside_after(value: Column, separator: str, quote: str, start: int) -> Column:
    """Whether a line leaves the reader inside a quoted field, if it finds it in state ``start``.

    Only a quote at the start of a field opens it; a doubled one inside stays inside.
    """

    def step(state: Column, part: Column) -> Column:
        fresh = F.endswith(part, F.lit(separator))
        return (
            F.when(state == _INSIDE, _CLOSED)
            .when((state != _ELSEWHERE) & (part == ""), _INSIDE)
            .when(fresh, _INSIDE)
            .otherwise(_ELSEWHERE)
        )

    parts = F.split(value, f"\\Q{quote}\\E", -1)
    last = F.aggregate(F.slice(parts, F.lit(1), F.size(parts) - 1), F.lit(start), step)
    return F.when(F.contains(value, F.lit(quote)), last == _INSIDE).otherwise(start == _INSIDE)


def states(steps: DataFrame) -> DataFrame:
    """``steps`` (source_file, block, place, after_outside, after_inside) with ``inside``, the state each line starts in.

    A line that ends in the same state from both sets it; of the others, some
    turn it.  The state is the one set last, turned as often as since then.
    """
    sets = F.when(F.col("after_outside") == F.col("after_inside"), F.col("after_outside"))
    turns = (F.col("after_outside") & ~F.col("after_inside")).cast("long")
    known = steps.withColumns({"_sets": sets.cast("int"), "_turns": turns})
    in_block = Window.partitionBy("source_file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    known = known.withColumn("_turned", F.coalesce(F.sum("_turns").over(in_block), F.lit(0)))
    mark = F.when(F.col("_sets").isNotNull(), F.struct(F.col("_sets").alias("value"), F.col("_turned").alias("turned")))
    known = known.withColumn("_mark", F.last(mark, ignorenulls=True).over(in_block))

    # What a whole block does, and the state each block starts in: one row per block of a file.
    blocks = known.groupBy("source_file", "block").agg(
        F.sum("_turns").alias("turns"), F.max_by(mark, F.when(mark.isNotNull(), F.col("place"))).alias("mark")
    )
    of_file = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    set_by = F.when(F.col("mark").isNotNull(), (F.col("mark.value") + F.col("turns") - F.col("mark.turned")) % 2)
    blocks = blocks.withColumn("set_by", set_by).withColumn("ahead", F.coalesce(F.sum("turns").over(of_file), F.lit(0)))
    set_mark = F.when(F.col("set_by").isNotNull(), F.struct(F.col("set_by").alias("value"), (F.col("ahead") + F.col("turns")).alias("turned")))
    blocks = blocks.withColumn("last_set", F.last(set_mark, ignorenulls=True).over(of_file))
    began = (F.coalesce("last_set.value", F.lit(0)) + F.col("ahead") - F.coalesce("last_set.turned", F.lit(0))) % 2
    blocks = blocks.select(F.col("source_file").alias("_file"), F.col("block").alias("_block"), began.alias("_began"))
    same = (F.col("source_file") == F.col("_file")) & (F.col("block") == F.col("_block"))
    inside = (F.coalesce("_mark.value", F.col("_began")) + F.col("_turned") - F.coalesce("_mark.turned", F.lit(0))) % 2 == 1
    return known.join(blocks, same).withColumn("inside", inside).select(*steps.columns, "inside")


def numbered_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    name_part: str = "",
    separator: str = ",",
    quote: str = '"',
    longest: int = RECORD_LENGTH,
) -> DataFrame:
    """Records of all files: value, source_file, block, place; lines inside a quoted field belong to one record.

    ``block`` and ``place`` are those of a record's first line, as in
    `lines.placed_lines`; line breaks inside a field become a line feed.  A
    field left open to the end of its file, and a record longer than
    ``longest``, are refused with an error that names the file.  Where no field
    goes over a line end, the lines are only looked at once more.
    """
    lines = placed_lines(spark, paths, name_part=name_part)
    steps = lines.withColumns(
        {
            "after_outside": _inside_after(F.col("value"), separator, quote, _START),
            "after_inside": _inside_after(F.col("value"), separator, quote, _INSIDE),
        }
    )
    if steps.where("after_outside").isEmpty():
        return lines
    known = cut_lineage(states(steps))
    goes_on = F.when(F.col("inside"), F.col("after_inside")).otherwise(F.col("after_outside"))
    known = known.withColumn("goes_on", goes_on)
    whole = known.where("NOT inside AND NOT goes_on").select(*lines.columns)
    parts = known.where("inside OR goes_on").withColumn("opens", (~F.col("inside")).cast("long"))
    parts = before(parts, ["source_file"], "block", ["place"], "opens", 2, "opened")
    record = ["source_file", (F.col("opened") + F.col("opens")).alias("record")]
    parts = cut_lineage(parts.select("value", "block", "place", "goes_on", *record))
    sizes = parts.groupBy("source_file", "record").agg(
        F.sum(F.length("value") + 1).alias("length"), F.count_if("goes_on").alias("open"), F.count(F.lit(1)).alias("lines")
    )
    wrong = sizes.where((F.col("length") > longest) | (F.col("open") == F.col("lines"))).orderBy("source_file", "record").head()
    if wrong is not None:
        what = "is longer than allowed" if wrong["length"] > longest else "is open to the end"
        raise ValueError(f"{wrong['source_file']} has a quoted field that {what}: {wrong['lines']} lines")
    ordered = F.sort_array(F.collect_list(F.struct("block", "place", "value")))
    joined = parts.groupBy("source_file", "record").agg(ordered.alias("lines"))
    joined = joined.select(
        F.array_join("lines.value", "\n").alias("value"), "source_file",
        F.col("lines")[0]["block"].alias("block"), F.col("lines")[0]["place"].alias("place"),
    )
    return whole.unionByName(joined)
