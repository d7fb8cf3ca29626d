"""Delimited reports with preamble lines, a header line and footer lines."""

from __future__ import annotations

import csv
from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.sources.config import config_table
from kpiloom.sources.files import Newest, NewestPerUnit, source_paths, unit_of
from kpiloom.sources.lines import only_line, without_ends
from kpiloom.sources.records import numbered_records

# The field that holds a record which does not parse.
BROKEN = "_broken"


def report_scan(
    spark: SparkSession,
    paths: str | Sequence[str] | Newest | NewestPerUnit,
    schema: str,
    *,
    skip_rows: Collection[int] = (),
    skip_footer: int = 0,
    columns: Sequence[str] | None = None,
    name_part: str = "",
    separator: str = ",",
    headings: Mapping[str, str] | None = None,
) -> DataFrame:
    """Body rows of every report file, of the newest one, or of the newest one per unit, with the file's path and the line's place in it.

    ``skip_rows`` are line numbers from 0; the first line left is the header and
    is dropped as well, as are the last ``skip_footer`` lines.  A quoted field
    may hold line breaks; all its lines count as one.

    With ``headings`` (schema name to heading) columns are taken by the names in
    each file's header line, whatever their order; a file without a wanted one
    is refused.  Without it they are taken by position.  A record that does not
    parse is refused too.
    """
    header = next(number for number in range(len(skip_rows) + 1) if number not in skip_rows)
    lines = numbered_records(spark, source_paths(spark, paths), name_part=name_part, separator=separator)
    body = without_ends(lines, top={header, *skip_rows}, footer=skip_footer)
    options = {"sep": separator, "escape": '"', "columnNameOfCorruptRecord": BROKEN}
    if headings is None:
        parsed = F.from_csv("value", f"{schema}, {BROKEN} STRING", options)
        rows = body.select("source_file", "block", "place", parsed.alias("row"))
    else:
        rows = _by_heading(lines, body, header, schema, headings, options)
    _refuse_broken(rows)
    wanted = columns or [field.name for field in T.StructType.fromDDL(schema).fields]
    return rows.select("source_file", "block", "place", *[f"row.{name}" for name in wanted])


def _refuse_broken(rows: DataFrame) -> None:
    """Raises on the first record that does not parse."""
    broken = rows.where(F.col(f"row.{BROKEN}").isNotNull()).select("source_file", F.substring(f"row.{BROKEN}", 1, 200).alias("line"))
    first = broken.head()
    if first is not None:
        raise ValueError(f"{first['source_file']} has a record that does not parse: {first['line']}")


def _by_heading(
    lines: DataFrame, body: DataFrame, header: int, schema: str, headings: Mapping[str, str], options: Mapping[str, str]
) -> DataFrame:
    """Rows parsed by the header of their file; files with the same header are read together."""
    layouts: dict[str, list[str]] = {}
    for row in only_line(lines, header).collect():  # one line per file
        layouts.setdefault(row["value"], []).append(row["source_file"])
    fields = T.StructType.fromDDL(schema).fields
    parts = []
    for line, files in layouts.items():
        names = [name.strip() for name in next(csv.reader([line.lstrip("\ufeff")], delimiter=options["sep"]))]
        missing = sorted({headings.get(f.name, f.name) for f in fields} - set(names))
        if missing:
            raise ValueError(f"{files[0]} has no column {', '.join(missing)}")
        types = {headings.get(f.name, f.name): f.dataType for f in fields}
        seen: set[str] = set()
        layout = T.StructType()
        for k, name in enumerate(names):
            first = name in types and name not in seen
            layout.add(f"c{k}", types[name] if first else T.StringType())
            seen.add(name)
        places = {f.name: names.index(headings.get(f.name, f.name)) for f in fields}
        layout.add(BROKEN, T.StringType())
        ddl = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in layout.fields)
        row = F.from_csv("value", ddl, dict(options))
        chosen = [F.col(f"row.c{k}").alias(name) for name, k in places.items()] + [F.col(f"row.{BROKEN}").alias(BROKEN)]
        of_layout = body if len(layouts) == 1 else body.where(F.col("source_file").isin(files))
        parsed = of_layout.select("source_file", "block", "place", row.alias("row"))
        parts.append(parsed.select("source_file", "block", "place", F.struct(*chosen).alias("row")))
    if not parts:
        empty = F.from_csv("value", f"{schema}, {BROKEN} STRING", dict(options)).alias("row")
        return body.select("source_file", "block", "place", empty)
    return reduce(DataFrame.unionByName, parts)


def with_sequence(report: DataFrame) -> DataFrame:
    """Line order of a `report_scan` as one sortable column ``seq``."""
    return report.withColumn("seq", F.struct("source_file", "block", "place")).drop("block", "place")


def tag_by_file(report: DataFrame, units: Mapping[str, str], column: str = "department") -> DataFrame:
    """The unit a report file belongs to, by file name; null for an unknown file."""
    name = F.substring_index("source_file", "/", -1)
    table = config_table(report.sparkSession, units, f"_file STRING, {column} STRING")
    return report.withColumn("_file", F.url_decode(name)).join(table, "_file", "left").drop("_file")


def tag_by_unit(report: DataFrame, source: NewestPerUnit, labels: Mapping[str, str], column: str = "department") -> DataFrame:
    """The label of the unit a report file belongs to by its path; null for a unit without one."""
    table = config_table(report.sparkSession, labels, f"_unit STRING, {column} STRING")
    return report.withColumn("_unit", unit_of(F.col("source_file"), source)).join(table, "_unit", "left").drop("_unit")


def csv_scan(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A plain CSV file with a header."""
    return spark.read.schema(schema).option("header", True).csv(path)
