"""The whole load of the small brokerage, and every report on the result."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from deedflow.plans import invoice, reports
from deedflow.operators import integrity
from deedflow.plans.load import load_all, reload_all, store_changes
from deedflow.sources.literals import literal_batch
from deedflow.sources.schema import LOAD_ORDER, TABLES, clear_order
from deedflow.sources.store import SnapshotStore
from tests import fixture_rows as fx

AS_OF = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = SnapshotStore(spark, str(tmp_path_factory.mktemp("store")))
    load_all(store, fx.batches(spark))
    return store


@pytest.fixture(scope="module")
def tables(store):
    return store.tables()


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_all_rows_are_loaded(tables):
    counts = {name: tables[name].count() for name in TABLES}
    assert counts == {
        "companies": 8, "owners": 12, "properties": 29, "contracts_owner": 27, "agents": 22,
        "clients": 20, "appointments": 20, "transactions": 23, "visits": 10, "reviews": 10,
        "log_transactions": 23,
    }
    assert sum(counts[name] for name in LOAD_ORDER) == 181


def test_tables_have_their_schema(tables):
    for name, table in TABLES.items():
        assert tables[name].schema == table.schema


def test_log_follows_the_arrival_order(tables):
    log = rows(tables["log_transactions"].orderBy("log_ID"))
    assert [r[0] for r in log] == list(range(1, 24))
    assert [r[2] for r in log] == [r[0] for r in fx.transaction_rows()]
    assert log[0] == (
        1, dt.date(2019, 4, 25), 5061, "Transaction Inserted", "New transaction added: 5061",
    )


def test_final_status(tables):
    status = dict(rows(tables["properties"].select("property_ID", "prop_status")))
    assert sorted(k for k, v in status.items() if v == "For Sale") == [2053, 2171]
    assert sum(v == "Sold" for v in status.values()) == 27


def test_sales_between(tables):
    found = rows(reports.sales_between(tables, "2021-01-01", "2021-12-31").orderBy("transaction_date"))
    assert found == [
        ("Ava", "Davis", dt.date(2021, 2, 18), "Duplex"),
        ("Isabella", "Anderson", dt.date(2021, 3, 8), "House"),
        ("Sophie", "Garcia", dt.date(2021, 8, 14), "Land/Plot"),
    ]
    assert reports.sales_between(tables, "2021-02-18", "2021-02-18").count() == 1


def test_top_customers(tables):
    found = rows(reports.top_customers(tables, 4))
    assert found[:3] == [
        (4202, "Aria", "Garcia", 2575000),
        (4126, "Sophie", "Garcia", 950000),
        (4989, "Emma", "Williams", 800000),
    ]
    assert (found[3][0], found[3][3]) == (4105, 750000)
    assert len(rows(reports.top_customers(tables))) == 3


def test_top_customers_breaks_ties_by_id(spark, tables):
    prices = tables["properties"].withColumn("listing_price", F.lit(1))
    sales = tables["transactions"].filter("client_ID != 4202")
    found = rows(reports.top_customers(tables | {"properties": prices, "transactions": sales}, 2))
    assert [r[0] for r in found] == [4105, 4111]


def test_period_summary(tables):
    found = rows(reports.period_summary(tables, "2019-01-01", "2021-01-01"))
    assert found == [
        ("03/2019 – 10/2020", Decimal(4400000), Decimal("2200000.0000"), Decimal("231578.9474"))
    ]


def test_period_summary_of_nothing_is_one_row_of_nulls(tables):
    assert rows(reports.period_summary(tables, "1990-01-01", "1991-01-01")) == [(None,) * 4]


def test_period_of_less_than_a_month(spark, tables):
    sales = [(1, 2651, 4651, 3147, None, fx.day("2020-01-31")), (2, 2736, 4651, 3147, None, fx.day("2020-02-29"))]
    sales = literal_batch(spark, "transactions", sales, fx.SALE_COLUMNS)
    found = rows(reports.period_summary(tables | {"transactions": sales}, "2020-01-01", "2021-01-01"))
    assert found == [("01/2020 – 02/2020", 800000, 800000, 800000)]


def test_sales_by_city(tables):
    assert dict(rows(reports.sales_by_city(tables))) == {
        "Hawaii": 4285000, "Texas": 3505000, "Florida": 2185000, "California": 1600000,
        "New York": 1150000, "Alabama": 550000,
    }


def test_reviewed_sale_cities(tables):
    found = {r[0] for r in rows(reports.reviewed_sale_cities(tables))}
    assert found == {"Hawaii", "California", "Florida", "Alabama"}


def test_reviewed_sale_cities_need_a_process_rating(spark, tables):
    unrated = [(1, 2651, 4651, 3147, None, fx.day("2019-04-25"))]
    unrated = literal_batch(spark, "transactions", unrated, fx.SALE_COLUMNS)
    assert rows(reports.reviewed_sale_cities(tables | {"transactions": unrated})) == []


def test_invoice_header(tables):
    header = invoice.invoice_header(tables, "Silver Oak Estates", 4202, AS_OF)
    assert header.columns == ["Company", "Date", "Invoice Number", "Customer Name", "Total Sales"]
    (found,) = rows(header)
    assert found[:2] + found[3:] == ("Silver Oak Estates", AS_OF, "Aria Garcia", 1825000)
    assert 0 <= found[2] <= 99999
    assert rows(header) == [found]
    drawn = invoice.invoice_header(tables, "Silver Oak Estates", 4202, random_number=True)
    assert 0 <= rows(drawn)[0][2] <= 99999


def test_invoice_header_without_a_sold_property_is_empty(spark, tables):
    unsold = tables | {"properties": fx.batches(spark)["properties"]}
    assert rows(invoice.invoice_header(unsold, "Silver Oak Estates", 4202, AS_OF)) == []
    assert rows(invoice.invoice_header(tables, "Nobody", 4202, AS_OF)) == []


def test_invoice_lines_add_up_to_the_header(spark, tables):
    lines = invoice.invoice_lines(tables, "Silver Oak Estates", 4202)
    found = rows(lines.orderBy("Transaction"))
    assert lines.columns == ["Transaction", "Property ID", "Type", "Price", "Agent"]
    assert found == [
        (5887, 2287, "Industrial Property", 900000, "Grace Garcia"),
        (5888, 2288, "Apartment", 550000, "Grace Garcia"),
        (5889, 2289, "Apartment", 375000, "Grace Garcia"),
    ]
    assert sum(r[3] for r in found) == 1825000
    view = invoice.define_view("invoice_details", lines)
    assert sorted(rows(view)) == found
    assert spark.sql("SELECT `Property ID` FROM invoice_details WHERE Transaction = 5887").first()[0] == 2287


def test_invoice_lines_refuse_an_ambiguous_company(spark, tables):
    twins = tables["companies"].union(spark.createDataFrame([(1, "Realty", "Town")], tables["companies"].schema))
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        invoice.invoice_lines(tables | {"companies": twins}, "Realty", 4202).collect()


def test_a_reopened_store_sees_the_last_version(spark, store):
    again = SnapshotStore(spark, store.root)
    assert again.version == store.version
    assert again.table("transactions").count() == 23


def test_reload(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "reload"))
    some = {k: v for k, v in fx.batches(spark).items() if k not in ("visits", "reviews", "appointments")}
    load_all(store, some)
    store.clear()
    assert all(store.table(name).count() == 0 for name in TABLES)
    reload_all(store, some)
    assert store.table("transactions").count() == 23
    # The counter of the log goes on after a clearing.
    log = store.table("log_transactions")
    assert sorted(r[0] for r in rows(log)) == list(range(24, 47))

    before = store.tables()
    deleted = spark.createDataFrame([(787,), (165,)], "company_ID int")
    store_changes(store, integrity.delete_rows(store.tables(), "companies", deleted))
    assert store.table("companies").count() == 6
    assert store.table("agents").filter("company_ID IS NULL").count() == 7
    assert store.table("contracts_owner").filter("company_ID IS NULL").count() == 7
    # Tables taken before a commit stay as they were.
    assert before["companies"].count() == 8
    renumbered = spark.createDataFrame([(4202, 14202)], "old_key int, new_key int")
    store_changes(store, integrity.renumber_rows(store.tables(), "clients", renumbered))
    assert rows(reports.top_customers(store.tables(), 1)) == [(14202, "Aria", "Garcia", 2575000)]
    with pytest.raises(integrity.IntegrityError, match="log_transactions.transaction_id"):
        sold = spark.createDataFrame([(5061,)], "transaction_ID int")
        integrity.delete_rows(store.tables(), "transactions", sold)


def test_clear_order_is_children_first():
    order = clear_order()
    for table in TABLES.values():
        for reference in table.references:
            assert order.index(table.name) < order.index(reference.parent)
