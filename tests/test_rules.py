"""The rule scripts, step by step on one store, and the corners of each rule."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deedflow.operators import gates
from deedflow.plans.judge import judge
from deedflow.plans.load import QUARANTINE, BatchRejected, apply_batch
from deedflow.sources.literals import literal_batch
from deedflow.sources.schema import TABLES
from deedflow.sources.store import SnapshotStore
from tests.fixture_rows import SALE_COLUMNS, day


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    return SnapshotStore(spark, str(tmp_path_factory.mktemp("rules")))


@pytest.fixture(scope="module")
def add(spark, store):
    def add_rows(name, *rows):
        columns = SALE_COLUMNS if name == "transactions" else None
        return apply_batch(store, name, literal_batch(spark, name, rows, columns))

    return add_rows


def sale(key, property_id, client, agent, rating, date):
    return (key, property_id, client, agent, Decimal(rating), day(date))


def status(store):
    return {r[0]: r[1] for r in store.table("properties").select("property_ID", "prop_status").collect()}


def logged(store):
    return [r[0] for r in store.table("log_transactions").orderBy("log_ID").select("transaction_id").collect()]


def test_rule_script(store, add):
    # One row per table, then three.
    add("companies", (165, "Realty", "Town"), (123, "A", "Town"), (456, "B", "Town"), (789, "C", "Town"))
    add("owners", (1254, "John", "Doe", "1"), (7890, "J", "S", "2"), (3456, "C", "W", "3"), (2345, "S", "B", "4"))
    add("properties", (2651, 1254, "House", "For Sale", "Hawaii", Decimal(2000), Decimal(500000)))
    add("contracts_owner", (8001, 2651, 165, day("2019-03-20"), "Yes", None))
    add("agents", (3147, 165, "M", "S", "1", Decimal(5)), (1111, 123, "D", "M", "2", None),
        (2222, 456, "J", "T", "3", None), (3333, 789, "D", "A", "4", None))
    add("clients", (4651, "Alice", "J", "1", None, "House"), (9999, "O", "J", "2", None, None),
        (8888, "M", "W", "3", None, None), (7777, "L", "D", "4", None, None))
    add("appointments", (6611, 3147, 4651, 2651, day("2019-03-21"), "Viewing"))
    assert logged(store) == []
    add("transactions", sale(5061, 2651, 4651, 3147, 8, "2019-04-25"))
    assert logged(store) == [5061]
    assert status(store) == {2651: "Sold"}

    size, price = Decimal(1200), Decimal(800000)
    add("properties", (9876, 7890, "Apartment", "For Sale", "New York", size, price),
        (6543, 3456, "House", "For Sale", "California", size, price),
        (5432, 2345, "Condominium", "For Sale", "Texas", size, price))
    add("contracts_owner", (9001, 9876, 123, day("2019-02-15"), "Yes", None),
        (9002, 6543, 456, day("2019-05-20"), "No", None),
        (9003, 5432, 789, day("2019-07-10"), "Yes", None))
    add("transactions", sale(7777, 9876, 9999, 1111, "8.5", "2019-04-15"),
        sale(8888, 6543, 8888, 2222, 7, "2019-07-05"),
        sale(9999, 5432, 7777, 3333, "9.5", "2019-09-15"))
    assert logged(store) == [5061, 7777, 8888, 9999]
    assert set(status(store).values()) == {"Sold"}

    # A sale marks its property, also one on hold, also in a batch.
    add("properties", (2864, 1254, "Apartment", "For Sale", "California", size, price))
    assert status(store)[2864] == "For Sale"
    add("transactions", sale(5864, 2864, 4651, 3147, 8, "2020-11-03"))
    assert status(store)[2864] == "Sold"
    add("properties", (2865, 1254, "Apartment", "For Sale", "California", size, price),
        (2866, 3456, "House", "On Hold", "Texas", size, price),
        (2867, 2345, "Condominium", "For Sale", "New York", size, price))
    add("transactions", sale(5865, 2865, 4651, 3147, 8, "2020-11-03"),
        sale(5866, 2866, 7777, 3333, "9.5", "2020-11-05"),
        sale(5867, 2867, 9999, 1111, "8.5", "2020-11-08"))
    assert set(status(store).values()) == {"Sold"}
    assert len(logged(store)) == 8

    # Sold already.
    version = store.version
    with pytest.raises(BatchRejected) as error:
        add("transactions", sale(5988, 2864, 4651, 3147, 6, "2020-04-25"))
    assert str(error.value) == (
        "Cannot perform a transaction on Property ID: 2864 that is already sold."
    )
    assert error.value.reason == gates.ALREADY_SOLD
    assert store.version == version and len(logged(store)) == 8

    # Appointment before the contract.
    with pytest.raises(BatchRejected) as error:
        add("appointments", (6554, 3147, 4651, 2651, day("2019-03-07"), "Viewing"))
    assert error.value.message.startswith("Date of appointment must be after the contract")

    # Review before the sale.
    with pytest.raises(BatchRejected) as error:
        add("reviews", (10864, 2864, 4651, Decimal(9), "Good", day("2019-11-01")))
    assert error.value.message == "Review ID: 10864 - Review date must be after transaction date."

    # A new contract puts a house up for sale again.
    add("owners", (1651, "John", "Legend", "5"))
    add("contracts_owner", (8651, 2651, 165, day("2019-09-30"), "No", None))
    assert status(store)[2651] == "For Sale"

    # A second open contract on that day is fine, an exclusive one is not.
    add("companies", (995, "D", "Town"), (631, "E", "Town"))
    add("contracts_owner", (8652, 2651, 995, day("2019-09-30"), "No", None))
    with pytest.raises(BatchRejected) as error:
        add("contracts_owner", (8653, 2651, 631, day("2019-09-30"), "Yes", None))
    assert error.value.reason == gates.EXCLUSIVITY_CLASH
    assert error.value.message.startswith("Cannot set exclusivity if contracts without exclusivity")
    assert store.table("contracts_owner").filter("property_ID = 2651").count() == 3

    # Bringing the folders of all batches together changes nothing.
    kept = store.table("transactions").orderBy("transaction_ID").collect()
    store.compact("transactions")
    assert len(store.version.folders["transactions"]) == 1
    assert store.table("transactions").orderBy("transaction_ID").collect() == kept

    # Two sales of the reopened house leave a review without the one to compare with.
    add("transactions", sale(6000, 2651, 4651, 3147, 8, "2020-01-01"))
    with pytest.raises(BatchRejected) as error:
        add("reviews", (10865, 2651, 4651, Decimal(4), "Nice", day("2022-01-01")))
    assert error.value.reason == gates.AMBIGUOUS_SALE


# Corners, each on its own small tables.


@pytest.fixture
def tables(spark):
    size, price = Decimal(1), Decimal(1)

    def made(name, *rows):
        return literal_batch(spark, name, rows).drop("seq")

    return {
        **{name: spark.createDataFrame([], table.schema) for name, table in TABLES.items()},
        "companies": made("companies", (1, "A", "X")),
        "owners": made("owners", (1, "O", "N", "1")),
        "properties": made(
            "properties",
            (1, 1, "House", "For Sale", "X", size, price),
            (2, 1, "Villa", "Sold", "X", size, price),
            (3, 1, "Villa", "On Hold", "X", size, price),
        ),
        "clients": made("clients", (1, "C", "L", "1", None, None)),
        "agents": made("agents", (1, 1, "A", "G", "1", None)),
        "contracts_owner": made(
            "contracts_owner",
            (1, 1, 1, day("2020-01-10"), "Yes", None),
            (2, 1, 1, day("2020-02-10"), "No", None),
        ),
    }


def verdicts(frame):
    return [r.reasons for r in frame.orderBy("seq").collect()]


def judged_sales(spark, tables, *sales):
    return judge("transactions", literal_batch(spark, "transactions", sales, SALE_COLUMNS), tables)


def test_second_sale_in_a_batch_is_rejected(spark, tables, tmp_path):
    batch = [sale(1, 1, 1, 1, 5, "2020-03-01"), sale(2, 1, 1, 1, 5, "2020-03-02"), sale(3, 3, 1, 1, 5, "2020-03-02")]
    assert verdicts(judged_sales(spark, tables, *batch)) == [[], ["already_sold"], []]
    store = SnapshotStore(spark, str(tmp_path))
    for name in ("companies", "owners", "properties", "clients", "agents"):
        store.add(name, tables[name])
    batch = literal_batch(spark, "transactions", batch, SALE_COLUMNS)
    with pytest.raises(BatchRejected):
        apply_batch(store, "transactions", batch)
    assert store.table("transactions").count() == 0
    result = apply_batch(store, "transactions", batch, QUARANTINE)
    assert result.accepted.count() == 2 and result.rejected.count() == 1
    assert logged(store) == [1, 3]
    (reject,) = store.rejected("transactions").collect()
    assert json.loads(reject.offered)["transaction_ID"] == 2
    assert reject.message.startswith("Cannot perform a transaction on Property ID: 1 ")


def test_sales_of_unknown_or_no_property(spark, tables):
    found = judged_sales(
        spark, tables, sale(1, None, 1, 1, 5, "2020-03-01"), sale(2, None, 1, 1, 5, "2020-03-01"),
        sale(3, 77, 1, 1, 5, "2020-03-01"), sale(4, 77, 1, 1, 5, "2020-03-01"),
    )
    assert verdicts(found) == [[], [], ["orphan:property_ID"], ["orphan:property_ID"]]


def test_a_row_that_fails_a_constraint_does_not_sell(spark, tables):
    found = judged_sales(
        spark, tables, sale(1, 1, 99, 1, 5, "2020-03-01"), sale(2, 1, 1, 1, 5, "2020-03-02"),
        sale(3, 1, 99, 1, 5, "2020-03-02"),
    )
    assert verdicts(found) == [["orphan:client_ID"], [], ["already_sold", "orphan:client_ID"]]


def test_repeated_key_with_the_first_rejected(spark, tables):
    found = judged_sales(spark, tables, sale(1, 2, 1, 1, 5, "2020-03-01"), sale(1, 3, 1, 1, 5, "2020-03-02"))
    assert verdicts(found) == [["already_sold"], []]


def test_keys_that_are_stored_already(spark, tables):
    batch = literal_batch(spark, "owners", [(1, "a", "b", "9"), (2, "a", "b", "1"), (3, "a", "b", "7"), (4, "a", "b", "7")])
    found = verdicts(judge("owners", batch, tables))
    assert found == [["duplicate:owner_ID"], ["duplicate:contact"], [], ["duplicate:contact"]]


def test_sale_contract_sale(spark, tables):
    def rows(property_id, *numbers):
        return literal_batch(
            spark, "transactions", [sale(n, property_id, 1, 1, 5, "2020-03-01") for n in numbers], SALE_COLUMNS
        ).withColumn("seq", _id("transaction_ID"))

    def contract(property_id, number):
        made = [(number, property_id, 1, day("2020-03-01"), None, None)]
        return literal_batch(spark, "contracts_owner", made).withColumn("seq", _id("contract_ID"))

    def outcome(property_id):
        judged = gates.sold_gate_with_contracts(
            rows(property_id, 1, 3, 4), contract(property_id, 2), tables["properties"]
        )
        return [r.reject for r in judged.orderBy("seq").collect()]

    assert outcome(1) == [None, None, "already_sold"]
    assert outcome(3) == [None, "already_sold", "already_sold"]
    assert outcome(2) == ["already_sold"] * 3


def _id(name):
    return F.col(name).cast("long")


def test_appointment_days(spark, tables):
    rows = [(n, 1, 1, p, day(d), "") for n, p, d in ((1, 1, "2020-01-10"), (2, 1, "2020-01-11"), (3, 3, "1999-01-01"))]
    found = judge("appointments", literal_batch(spark, "appointments", rows), tables)
    assert verdicts(found) == [["appointment_before_contract"], [], []]


def test_review_days(spark, tables):
    sales = [sale(1, 1, 1, 1, 5, "2020-03-01"), sale(2, 2, 1, 1, 5, "2020-03-01"), sale(3, 2, 1, 1, 5, "2020-04-01")]
    tables["transactions"] = literal_batch(spark, "transactions", sales, SALE_COLUMNS).drop("seq")
    rows = [(n, p, 1, None, None, day(d)) for n, p, d in (
        (1, 1, "2020-03-01"), (2, 1, "2020-03-02"), (3, 3, "1999-01-01"), (4, 2, "2024-01-01"))]
    found = judge("reviews", literal_batch(spark, "reviews", rows), tables)
    assert verdicts(found) == [["review_before_sale"], [], [], ["ambiguous_sale"]]


def judged_contracts(spark, tables, date, *values, properties=None, **options):
    rows = [
        (10 + n, (properties or {}).get(n, 1), 1, day(date), v, None) for n, v in enumerate(values)
    ]
    found = judge("contracts_owner", literal_batch(spark, "contracts_owner", rows), tables, **options)
    return [not reasons for reasons in verdicts(found)]


@pytest.mark.parametrize("value", [None, "No", "Yes"])
def test_exclusivity_against_stored_contracts(spark, tables, value):
    assert judged_contracts(spark, tables, "2020-01-10", value) == [False]
    assert judged_contracts(spark, tables, "2020-02-10", value) == [value != "Yes"]


def test_exclusivity_within_a_batch(spark, tables):
    found = judged_contracts(spark, tables, "2020-05-05", None, "Yes", None, "No")
    assert found == [True, True, False, False]


def test_exclusivity_scope(spark, tables):
    two = {0: 1, 1: 3}
    assert judged_contracts(spark, tables, "2020-05-05", "Yes", "Yes", properties=two) == [True, False]
    found = judged_contracts(
        spark, tables, "2020-05-05", "Yes", "Yes", properties=two, scope=("property_ID", "date_contract")
    )
    assert found == [True, True]


def test_values_that_do_not_fit(spark, tables):
    wide = {"rating_property": T.DecimalType(6, 2), "date_review": T.StringType()}
    rows = [
        (1, 1, 1, Decimal("8.55"), "a", "2020-01-01"),
        (2, 1, 1, Decimal("10"), "b", "2020-01-01"),
        (123456, 1, 1, Decimal("8.50"), "c", "2020-01-01"),
        (4, 1, 1, Decimal("8.50"), "d", "soon"),
        (5, None, 1, None, None, "2020-01-01"),
    ]
    found = judge("reviews", literal_batch(spark, "reviews", rows, types=wide), tables).orderBy("seq").collect()
    assert [r.reasons for r in found] == [
        [],
        ["type:rating_property"],
        ["type:review_ID"],
        ["type:date_review"],
        [],
    ]
    # Too many decimals are rounded, as an insert does.
    assert found[0].rating_property == Decimal("8.6")
    assert json.loads(found[1].offered)["rating_property"] == 10
    assert found[4].offered is None and found[4].date_review == day("2020-01-01")


def test_rows_that_come_as_text(spark, tables):
    text = {name: T.StringType() for name in TABLES["properties"].columns}
    rows = [
        ("0011", "1", "House", "Sold", "X", "1", "500"),
        ("12", "1", "House", "Sold", "X", "large", "500"),
        ("13", "one", "House", "Sold", "X", "0", "500"),
        ("14", "1", "House", "Sold", "X", "10.5", "500"),
    ]
    found = judge("properties", literal_batch(spark, "properties", rows, types=text), tables)
    assert verdicts(found) == [
        [],
        ["type:size"],
        ["type:owner_ID", "check:positive_size_and_price"],
        [],
    ]
    assert found.filter("accepted").select("property_ID", "listing_price").first() == (11, Decimal(500))


def test_required_values_domains_and_checks(spark, tables):
    one = Decimal(1)
    rows = [
        (11, None, "House", "Sold", "X", one, one),
        (None, 1, "House", "Sold", "X", one, one),
        (13, 1, "Castle", "Sold", "X", one, one),
        (14, 1, "House", None, "X", one, one),
        (15, 1, "House", "Sold", "X", Decimal(0), one),
        (16, 1, "House", "Sold", "X" * 31, one, one),
        (17, 8, "House", "Sold", "X", one, one),
    ]
    assert verdicts(judge("properties", literal_batch(spark, "properties", rows), tables)) == [
        [],
        ["not_null:property_ID"],
        ["domain:property_TYPE"],
        ["not_null:prop_status"],
        ["check:positive_size_and_price"],
        ["type:city"],
        ["orphan:owner_ID"],
    ]
    rows = [(1, None, "a", "b", "5", None), (2, 1, "a", "b", "6", Decimal(0)), (3, 1, "a", "b", "1", one)]
    nobody = tables | {"agents": tables["agents"].filter("agent_ID > 1")}
    assert verdicts(judge("agents", literal_batch(spark, "agents", rows), nobody)) == [
        [], ["check:positive_rate"], [],
    ]
    rows = [(1, 1, 1, 3, day("2020-01-01"), ""), (2, 1, 1, 3, day("2020-01-01"), None), (3, 1, 1, 3, None, "Walk")]
    assert verdicts(judge("appointments", literal_batch(spark, "appointments", rows), tables)) == [
        [], ["not_null:type_appointment"], ["not_null:date_appointment", "domain:type_appointment"],
    ]
