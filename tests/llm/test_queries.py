"""Queries with SQL against a second engine, on given tables."""

import os

import duckdb
import pytest

from deedflow.llm.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_LLM_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "conversations"):
        path = f"{FOLDER}/{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return connection


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_result(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    expected = duck.execute(ORACLES[name])
    columns = sorted(c[0] for c in expected.description)
    assert sorted(result.columns) == columns
    place = [[c[0] for c in expected.description].index(c) for c in columns]
    wanted = sorted((tuple(row[i] for i in place) for row in expected.fetchall()), key=str)
    found = sorted((tuple(row[c] for c in columns) for row in result.collect()), key=str)
    assert found == wanted
    assert found


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
