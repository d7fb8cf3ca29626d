"""Base tables read over JDBC; joins and filters are left to Spark."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Split:
    """Ranges of a column that a table is read in, each over a connection of its own.

    The bounds only place the splits: rows outside them are read too.
    """

    column: str
    lower: object
    upper: object
    partitions: int = 200

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def balanced_ranges(keys: DataFrame, column: str, parts: int, *, accuracy: int = 10_000) -> list[str]:
    """Predicates on ``column`` that every row meets exactly one of, each by about the same number of ``keys``.

    ``keys`` is a sample of the column, or a short key table.  Bounds are its
    quantiles, so that gaps and crowded stretches of the keys do not matter; a
    key as frequent as several parts shares its range with no more than a part.
    Rows without a key are read with the first range, rows beyond the sample
    with the first and last ones.
    """
    kind = keys.schema[column].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.NumericType)):
        shares = [k / parts for k in range(1, parts)]
        found = keys.select(F.percentile_approx(column, shares, accuracy).alias("bounds")).first()["bounds"] if shares else []
    else:
        raise TypeError(f"{column} is {kind.simpleString()}: ranges need a number, a date or a time")
    bounds = sorted(set(found or []))
    least = keys.agg(F.min(column)).first()[0]
    bounds = [value for value in bounds if value != least]
    literals = [_literal(value) for value in bounds]
    if not literals:
        return [f"{column} IS NULL OR {column} IS NOT NULL"]
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(literals, literals[1:])]
    return [f"{column} < {literals[0]} OR {column} IS NULL", *between, f"{column} >= {literals[-1]}"]


def _literal(value) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ', timespec='microseconds')}'"
    return f"DATE '{value}'" if isinstance(value, date) else str(value)


def connection_options(config: dict) -> dict[str, str]:
    """Reader options from a connection config: url, user, password and optional driver."""
    wanted = ("url", "user", "password", "driver")
    return {key: str(config[key]) for key in wanted if config.get(key) is not None}


def database_table(
    spark: SparkSession, config: dict, table: str, *, split: Split | Sequence[str] | None, fetch_size: int = 10_000
) -> DataFrame:
    """One base table; Spark pushes column choice and plain filters into the database.

    ``split`` is ranges of equal width, or the predicates of `balanced_ranges`,
    each read over a connection of its own.  It has no default: only a short
    table may be read over one connection, and the caller says so with None.
    """
    if split is not None and not isinstance(split, Split):
        options = connection_options(config)
        properties = {**{key: value for key, value in options.items() if key != "url"}, "fetchsize": str(fetch_size)}
        return spark.read.jdbc(options["url"], table, predicates=list(split), properties=properties)
    reader = spark.read.format("jdbc").options(**connection_options(config))
    if split is not None:
        reader = reader.options(**split.options())
    return reader.option("fetchsize", str(fetch_size)).option("dbtable", table).load()


def database_tables(
    spark: SparkSession, config: dict, tables: Mapping[str, tuple[str, Split | Sequence[str] | None]]
) -> dict[str, DataFrame]:
    """Base tables by the names the extracts know them by: name to database table and split."""
    return {name: database_table(spark, config, table, split=split) for name, (table, split) in tables.items()}
