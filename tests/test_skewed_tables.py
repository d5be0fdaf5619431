"""All queries on tables in which one key holds a third of the rows and some are NULL."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from deedflow.plans.star_queries import QUERIES
from deedflow.operators import ordering, skew
from tests.test_oracles import TABLES, sorted_rows

SOURCE = "/root/testdata/sf0.001"

# A third of the orders, lines and events go to one customer, order, part or user.
CHANGES = {
    "orders": """SELECT * REPLACE (
        CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 10 = 1 THEN NULL ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 3 = 1 THEN TIMESTAMP '1996-05-05' ELSE o_orderdate END AS o_orderdate)
        FROM orders""",
    "lineitem": """SELECT * REPLACE (
        CASE WHEN l_quantity % 3 = 0 THEN 11 WHEN l_quantity = 1 THEN NULL ELSE l_partkey END AS l_partkey,
        CASE WHEN l_quantity % 3 = 1 THEN 5 WHEN l_quantity = 2 THEN NULL ELSE l_orderkey END AS l_orderkey)
        FROM lineitem""",
    "events": """SELECT * REPLACE (
        CASE WHEN event_id % 3 = 0 THEN 11 WHEN event_id % 10 = 1 THEN NULL ELSE user_id END AS user_id)
        FROM events""",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    source = duckdb.connect()
    for name in TABLES:
        source.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SOURCE}/{name}.parquet'")
        rows = CHANGES.get(name, f"SELECT * FROM {name}")
        source.execute(f"COPY ({rows}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", [n for n in QUERIES if n[0] in "qvgkjs"])
def test_same_result(spark, duck, folder, name, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 50)
    monkeypatch.setattr(ordering, "HOT_ROWS", 50)
    result = entry_points.queries()[name](spark, folder)
    expected = duck.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    found = sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    assert found == sorted_rows(columns, expected.fetchall())
