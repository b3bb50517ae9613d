"""Every registered query against its SQL, on the given tables."""

import math
import os
from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
from tideline_queries import QUERIES

duckdb = pytest.importorskip("duckdb")
DATA = os.environ.get("TIDELINE_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def as_lines(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    out = spark_entry.queries()[name](spark, DATA)
    wanted = tables.execute(spark_entry.oracle_sql()[name])
    names = [d[0] for d in wanted.description]
    assert sorted(out.columns) == sorted(names)
    rows = as_lines(out.columns, out.collect())
    assert rows
    assert rows == as_lines(names, wanted.fetchall())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
