"""Whole batches against a row-by-row host: constraints and rules together."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from deedflow.plans.judge import judge
from deedflow.sources.literals import literal_batch
from deedflow.sources.schema import TABLES
from tests.fixture_rows import SALE_COLUMNS

DAY = dt.date(2020, 1, 1)
PROPERTIES = {1: "For Sale", 2: "Sold", 3: "On Hold", 4: "For Sale", 5: "For Sale"}


@pytest.fixture(scope="module")
def tables(spark):
    def made(name, rows, columns=None):
        return literal_batch(spark, name, rows, columns).drop("seq")

    return {
        **{name: spark.createDataFrame([], table.schema) for name, table in TABLES.items()},
        "properties": made(
            "properties", list(PROPERTIES.items()), ["property_ID", "prop_status"]
        ),
        "clients": made("clients", [(1,), (2,)], ["client_ID"]),
        "transactions": made("transactions", [(100,), (101,)], ["transaction_ID"]),
        "contracts_owner": made(
            "contracts_owner",
            [(100, DAY + dt.timedelta(1), "Yes"), (101, DAY + dt.timedelta(2), "No")],
            ["contract_ID", "date_contract", "exclusivity"],
        ),
    }


@pytest.mark.parametrize("hot_rows", [3, None])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sales(spark, tables, seed, hot_rows):
    rng = random.Random(seed)
    rows = [
        (
            rng.choice([None, 100, *range(1, 90)]),
            rng.choice([1, 1, 1, 2, 3, 4, 5, 77, None]),
            rng.choice([1, 1, 1, 2, 88, None]),
            None,
            None,
            rng.choice([DAY] * 9 + [None]),
        )
        for _ in range(120)
    ]

    def alone(row):
        key, property_id, client, _, _, day = row
        return (
            key not in (None, 100)
            and property_id in (None, *PROPERTIES)
            and client in (None, 1, 2)
            and day is not None
        )

    status, keys, wanted = dict(PROPERTIES), set(), []
    for row in rows:
        gate = status.get(row[1]) == "Sold"
        accepted = alone(row) and row[0] not in keys and not gate
        wanted.append((accepted, gate))
        if accepted:
            keys.add(row[0])
        if accepted and row[1] in status:
            status[row[1]] = "Sold"
    batch = literal_batch(spark, "transactions", rows, SALE_COLUMNS)
    found = judge("transactions", batch, tables, hot_rows=hot_rows).orderBy("seq").collect()
    assert [(r.accepted, r.reasons[:1] == ["already_sold"]) for r in found] == wanted
    assert [r.offered is None for r in found] == [r.accepted for r in found]
    assert [(r.transaction_ID, r.property_ID) for r in found] == [row[:2] for row in rows]


@pytest.mark.parametrize("hot_rows", [3, None])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_contracts(spark, tables, seed, hot_rows):
    rng = random.Random(seed)
    rows = [
        (
            rng.choice([100, *range(1, 60)]),
            rng.choice([1, 2, None, 77]),
            None,
            DAY + dt.timedelta(rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 6])),
            rng.choice([None, "No", "No", "Yes", "Maybe"]),
            None,
        )
        for _ in range(80)
    ]

    def alone(row):
        return row[0] != 100 and row[1] != 77 and row[4] != "Maybe"

    keys, held = set(), [(DAY + dt.timedelta(1), "Yes"), (DAY + dt.timedelta(2), "No")]
    wanted = []
    for row in rows:
        day, value = row[3], row[4]
        gate = (day, "Yes") in held or ((day, "No") in held and value == "Yes")
        accepted = alone(row) and row[0] not in keys and not gate
        wanted.append((accepted, gate))
        if accepted:
            keys.add(row[0])
            held.append((day, value))
    batch = literal_batch(spark, "contracts_owner", rows)
    found = judge("contracts_owner", batch, tables, hot_rows=hot_rows).orderBy("seq").collect()
    assert [(r.accepted, r.reasons[:1] == ["exclusivity_clash"]) for r in found] == wanted


@pytest.mark.parametrize("seed", [1, 2])
def test_owners_with_two_keys(spark, tables, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(1, 30), "a", "b", rng.choice([None, *"abcdefghijklmnopqrst"])) for _ in range(120)]
    ids, contacts, wanted = set(), set(), []
    for key, _, _, contact in rows:
        accepted = contact is not None and key not in ids and contact not in contacts
        wanted.append(accepted)
        if accepted:
            ids.add(key)
            contacts.add(contact)
    found = judge("owners", literal_batch(spark, "owners", rows), tables).orderBy("seq").collect()
    assert [r.accepted for r in found] == wanted
    assert all(r.reasons for r in found if not r.accepted)


def test_appointments_hold_no_key_if_too_early(spark, tables):
    contract = literal_batch(spark, "contracts_owner", [(100, 1, DAY)], ["contract_ID", "property_ID", "date_contract"])
    held = tables | {"contracts_owner": contract.drop("seq")}
    columns = ["appointment_ID", "property_ID", "date_appointment", "type_appointment"]
    rows = [(1, 1, DAY, "Viewing"), (1, 1, DAY + dt.timedelta(1), "Viewing"), (1, 2, DAY, "Viewing")]
    found = judge("appointments", literal_batch(spark, "appointments", rows, columns), held).orderBy("seq").collect()
    assert [r.accepted for r in found] == [False, True, False]
    assert [r.reasons for r in found] == [["appointment_before_contract"], [], ["duplicate:appointment_ID"]]


def test_rows_without_a_number_of_their_own(spark, tables):
    rows = [(i, 1, 1, None, None, DAY) for i in range(1, 6)]
    batch = literal_batch(spark, "transactions", rows, SALE_COLUMNS)
    numbers = F.when(F.col("seq") == 1, F.lit(None)).when(F.col("seq") <= 3, "7").when(F.col("seq") == 4, "x")
    batch = batch.withColumn("seq", F.coalesce(numbers, F.when(F.col("seq") == 5, "8"))).withColumnRenamed("property_ID", "property_id")
    found = {r.transaction_ID: r.reasons for r in judge("transactions", batch, tables).collect()}
    assert found == {1: ["type:seq"], 2: ["duplicate:seq"], 3: ["duplicate:seq"], 4: ["type:seq"], 5: []}
