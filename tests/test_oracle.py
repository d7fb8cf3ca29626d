"""Every query against its SQL text in DuckDB: names, types, rows."""

import os
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = [name[: -len(".parquet")] for name in sorted(os.listdir(FOLDER))]
# Queries that have SQL; the text queries without it have tests of their own.
NAMES = sorted(set(oracle_sql()) & set(queries()))


def as_duck(table):
    simple = [
        pa.field(field.name, pa.string() if pa.types.is_large_string(field.type) else field.type) for field in table.schema
    ]
    return table.cast(pa.schema(simple))


def rows_of(table):
    names = sorted(table.column_names)
    return Counter(zip(*[table.column(name).to_pylist() for name in names]))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    text = {name for name in queries() if name == "pipeline" or name.startswith("op") and name[2].isdigit()}
    assert set(oracle_sql()) <= set(queries())
    assert set(queries()) - set(oracle_sql()) <= text


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, name):
    ours = as_duck(queries()[name](spark, FOLDER).toArrow())
    theirs = as_duck(duck.sql(oracle_sql()[name]).to_arrow_table())
    assert {f.name: f.type for f in ours.schema} == {f.name: f.type for f in theirs.schema}
    assert rows_of(ours) == rows_of(theirs)
    assert ours.num_rows > 0


def test_entry(spark):
    assert entry(spark).count() == 6
