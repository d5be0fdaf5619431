"""Constraint reports, key maintenance and the helpers around them."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deedflow.functions import dates, money, text
from deedflow.operators import effects, integrity, quality
from deedflow.sources.literals import append_rows, literal_batch
from deedflow.sources.schema import TABLES, Field


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_duplicate_keys(spark):
    frame = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert rows(quality.duplicate_keys(frame, ["a", "b"])) == [(1, 1, 2)]
    assert rows(quality.duplicate_keys(frame, ["a", "b"], True)) == [(1, 1, 2), (None, 1, 2)]


def test_null_profile(spark):
    frame = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert rows(quality.null_profile(frame, ["a", "b"])) == [(1, 2)]


def test_checks_and_domains_let_null_pass(spark):
    frame = spark.createDataFrame([(0, "a"), (1, "b"), (None, None), (2, "")], "n int, s string")
    assert rows(quality.check_violations(frame, "n > 0")) == [(0, "a")]
    assert rows(quality.domain_violations(frame, "s", ["a", ""])) == [(1, "b")]


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(quality.orphans(child, "fk", parent, "id")) == [(2, 2)]


@pytest.mark.parametrize("table", list(TABLES))
def test_every_table_has_a_conformity_report(spark, table):
    empty = spark.createDataFrame([], TABLES[table].schema)
    assert set(rows(quality.conformity_report(empty, TABLES[table]))[0]) == {0}


def test_conformity(spark):
    given = T.StructType([T.StructField("rate", T.DecimalType(6, 2))])
    frame = spark.createDataFrame([(Decimal(v),) for v in ("8.55", "10", "8.50")] + [(None,)], given)
    bad = quality.nonconforming(Field("rate", T.DecimalType(2, 1)), T.DecimalType(6, 2))
    assert rows(frame.filter(bad)) == [(Decimal("10.00"),), (Decimal("8.55"),)]
    assert rows(frame.filter("rate < 10").select(F.col("rate").cast("decimal(2,1)")).distinct()) == [
        (Decimal("8.5"),), (Decimal("8.6"),),
    ]


def test_text_that_should_be_something_else(spark):
    frame = spark.createDataFrame(
        [("0165", "2020-01-31"), ("x", "2020-1-31"), ("8.5", "soon"), (None, None), ("1234567", "")],
        "n string, d string",
    )
    number = Field("n", T.IntegerType(), digits=6)
    rate = Field("n", T.DecimalType(2, 1))
    day = Field("d", T.DateType())
    bad = [quality.nonconforming(f, T.StringType()) for f in (number, rate, day)]
    assert [tuple(r) for r in frame.select(*bad).collect()] == [
        (False, True, False), (True, True, False), (True, False, True), (False, False, False),
        (True, True, True),
    ]


def test_whole_units(spark):
    frame = spark.createDataFrame(
        [(dt.date.fromisoformat(a), dt.date.fromisoformat(b)) for a, b in (
            ("2019-03-22", "2020-10-07"), ("2020-01-31", "2020-02-29"), ("2020-02-29", "2021-02-28"))],
        "a date, b date",
    )
    a, b = F.col("a"), F.col("b")
    units = frame.select(dates.whole_years(a, b), dates.whole_months(a, b), dates.period_label(a, b))
    assert [tuple(r) for r in units.collect()] == [
        (1, 18, "03/2019 – 10/2020"), (0, 0, "01/2020 – 02/2020"), (0, 11, "02/2020 – 02/2021"),
    ]


def test_ratio_has_four_places(spark):
    quotient = money.ratio(F.lit(Decimal(4400000)), F.lit(19))
    assert spark.range(1).select(quotient).first()[0] == Decimal("231578.9474")
    cases = [(100040, 101, "990.4950"), (1, 20000, "0.0001"), (1, 20001, "0.0000"), (-100040, 101, "-990.4950")]
    for total, units, expected in cases:
        quotient = money.ratio(F.lit(Decimal(total)).cast("decimal(38,0)"), F.lit(units).cast("long"))
        assert spark.range(1).select(quotient).first()[0] == Decimal(expected)


def test_joined_is_null_if_a_part_is(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    assert rows(frame.select(text.joined("x", F.col("n"), F.col("s")))) == [("x1a",), (None,)]


def test_date_filters_on_dates_and_timestamps(spark):
    days = [dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2, 23), dt.datetime(2020, 1, 3)]
    for kind in ("date", "timestamp", "timestamp_ntz"):
        frame = spark.createDataFrame([(d,) for d in days], "d timestamp_ntz").select(F.col("d").cast(kind))
        assert dates.on_days(frame, "d", "2020-01-01", "2020-01-02").count() == 2
        assert dates.within(frame, "d", "2020-01-01", "2020-01-03").count() == 2


def test_subset_append(spark):
    frame = spark.createDataFrame([(1, "a")], "n int, s string")
    assert rows(append_rows(frame, frame.select("n"))) == [(1, "a"), (1, None)]
    made = literal_batch(spark, "companies", [(165,)], ["company_ID"])
    assert made.columns == ["company_ID", "comp_name", "city", "seq"]
    assert rows(made) == [(165, None, None, 1)]


def test_reopen_touches_houses_only(spark):
    frame = spark.createDataFrame(
        [(1, "House", "Sold"), (2, "Villa", "Sold"), (3, "House", "On Hold"), (4, "House", "Sold")],
        "property_ID int, property_TYPE string, prop_status string",
    )
    contracts = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "property_ID int")
    assert rows(effects.reopen(frame, contracts).select("property_ID", "prop_status")) == [
        (1, "For Sale"), (2, "Sold"), (3, "For Sale"), (4, "Sold"),
    ]


@pytest.fixture
def tables(spark):
    day = dt.date(2020, 1, 1)
    data = {
        "companies": [(1, "A", "X"), (2, "B", "X")],
        "agents": [(1, 1, "a", "b", "1", None), (2, 2, "a", "b", "2", None), (3, None, "a", "b", "3", None)],
        "contracts_owner": [(1, None, 1, day, None, None), (2, None, 2, day, None, None)],
        "appointments": [(1, 1, None, None, day, ""), (2, 2, None, None, day, "")],
        "transactions": [(1, None, None, 1, None, day, None)],
        "visits": [(1, 1, "Y")],
    }
    return {
        name: literal_batch(spark, name, data[name]).drop("seq")
        if name in data
        else spark.createDataFrame([], table.schema)
        for name, table in TABLES.items()
    }


def keys(spark, name, *values):
    return spark.createDataFrame([(v,) for v in values], f"{name} int")


def test_delete_sets_references_to_null(spark, tables):
    changed = integrity.delete_rows(tables, "companies", keys(spark, "company_ID", 1))
    assert set(changed) == {"companies", "agents", "contracts_owner"}
    twice = integrity.delete_rows(tables, "companies", keys(spark, "company_ID", 1, 1, None))
    assert all(rows(twice[name]) == rows(changed[name]) for name in changed)
    assert rows(changed["companies"].select("company_ID")) == [(2,)]
    assert rows(changed["agents"].select("agent_ID", "company_ID")) == [(1, None), (2, 2), (3, None)]
    assert rows(changed["contracts_owner"].select("company_ID")) == [(2,), (None,)]
    for name, frame in changed.items():
        assert frame.columns == TABLES[name].columns


def test_restricted_delete(spark, tables):
    with pytest.raises(integrity.IntegrityError, match="visits.appointment_id"):
        integrity.delete_rows(tables, "appointments", keys(spark, "appointment_ID", 1, 2))
    changed = integrity.delete_rows(tables, "appointments", keys(spark, "appointment_ID", 2))
    assert changed["appointments"].count() == 1


def test_renumbering_cascades(spark, tables):
    mapping = spark.createDataFrame([(1, 11)], "old_key int, new_key int")
    changed = integrity.renumber_rows(tables, "agents", mapping)
    assert set(changed) == {"agents", "appointments", "transactions"}
    assert rows(changed["agents"].select("agent_ID")) == [(11,), (2,), (3,)]
    assert rows(changed["appointments"].select("agent_ID")) == [(11,), (2,)]
    assert changed["agents"].schema["agent_ID"].dataType == T.IntegerType()
    twice = spark.createDataFrame([(1, 11), (1, 11)], "old_key int, new_key int")
    assert rows(integrity.renumber_rows(tables, "agents", twice)["appointments"]) == rows(changed["appointments"])
    for bad in ([(1, 11), (1, 12)], [(None, 11)], [(1, None)]):
        with pytest.raises(integrity.IntegrityError, match="one new key each"):
            integrity.renumber_rows(tables, "agents", spark.createDataFrame(bad, "old_key int, new_key int"))
    clash = spark.createDataFrame([(1, 2)], "old_key int, new_key int")
    with pytest.raises(integrity.IntegrityError, match="not unique"):
        integrity.renumber_rows(tables, "agents", clash)
