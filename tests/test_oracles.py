"""Every query on the star schema against the same query in a second engine."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from __spark_entry__ import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else float(f"{value:.12g}")
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(normal(row[i]) for i in order) for row in rows]
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_result(spark, duck, name):
    result = entry_points.queries()[name](spark, FOLDER)
    expected = duck.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    found = sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    wanted = sorted_rows(columns, expected.fetchall())
    assert len(found) == len(wanted)
    assert found == wanted
    assert found or name == "v2_invoice_lines"
    assert not any(isinstance(v, float) and math.isnan(v) for row in found for v in row)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 3


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
