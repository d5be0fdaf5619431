"""Every report, rule and check, bound to the star schema's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deedflow.functions.dates import month_label, on_days, whole_months, whole_years, within
from deedflow.functions.money import ratio, total_or_zero
from deedflow.functions.text import full_name, invoice_number, joined
from deedflow.operators import effects, gates, integrity, ordering, quality
from deedflow.operators.skew import spread_join
from deedflow.plans import invoice, reports
from deedflow.plans.judge import judge
from deedflow.plans.star_load import bulk_load
from deedflow.sources import star
from deedflow.sources.literals import append_rows
from deedflow.sources.schema import TABLES, Field
from deedflow.sources.store import empty

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

COMPANY = "NATION_19"
CLIENT = 86
AS_OF = dt.date(2024, 1, 1)


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _as_double(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("double") for c in columns})


def _outcome(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(*columns, F.coalesce("reject", F.lit("accepted")).alias("outcome"))


def _sold_in_1995(spark: SparkSession, folder: str) -> DataFrame:
    """Parts, sold if ordered in 1995."""
    sales = within(star.transactions(spark, folder), "date_transaction", "1995-01-01", "1996-01-01")
    return effects.mark_sold(star.properties(spark, folder), sales)


# Reports and invoices


@_query
def q1_sales_between(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sales_between(star.brokerage(spark, folder), "1996-01-01", "1996-12-31")


@_query
def q2_top_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _as_double(reports.top_customers(star.brokerage(spark, folder), 3), "total_spent")


@_query
def q3_period_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = reports.period_summary(star.brokerage(spark, folder), "1996-01-01", "1998-01-01")
    return _as_double(summary, "TotalSales", "YearlyAverage", "MonthlyAverage")


@_query
def q4_sales_by_city(spark: SparkSession, folder: str) -> DataFrame:
    return _as_double(reports.sales_by_city(star.brokerage(spark, folder)), "total_sales")


@_query
def q5_reviewed_cities(spark: SparkSession, folder: str) -> DataFrame:
    return reports.reviewed_sale_cities(star.brokerage(spark, folder))


@_query
def v1_invoice_header(spark: SparkSession, folder: str) -> DataFrame:
    tables = star.brokerage(spark, folder) | {"properties": _sold_in_1995(spark, folder)}
    header = invoice.invoice_header(tables, COMPANY, CLIENT, AS_OF)
    return _as_double(header, "Total Sales")


@_query
def v2_invoice_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = invoice.invoice_lines(star.brokerage(spark, folder), COMPANY, CLIENT)
    return _as_double(lines, "Price")


# Row rules


@_query
def g1_audit_log(spark: SparkSession, folder: str) -> DataFrame:
    orders = star.read(spark, folder, "orders")
    return effects.audit_log(orders, "o_orderkey", "o_orderdate", "o_orderkey")


@_query
def g2_mark_sold(spark: SparkSession, folder: str) -> DataFrame:
    return _sold_in_1995(spark, folder).select("property_ID", "prop_status")


def _customers_as_properties(spark: SparkSession, folder: str) -> DataFrame:
    """Customers, sold if in debt; two market segments stand for houses."""
    houses = F.col("c_mktsegment").isin("HOUSEHOLD", "BUILDING")
    return star.read(spark, folder, "customer").select(
        F.col("c_custkey").alias("property_ID"),
        F.when(F.col("c_acctbal") < 0, "Sold").otherwise("For Sale").alias("prop_status"),
        F.when(houses, "House").otherwise("Villa").alias("property_TYPE"),
    )


def _orders_as_rows(spark: SparkSession, folder: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    return star.read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_custkey").alias("property_ID"),
        F.col("o_orderdate").alias("day"),
        "o_orderstatus",
        "o_orderpriority",
        F.when(priority == "1-URGENT", "Yes")
        .when(priority != "4-NOT SPECIFIED", "No")
        .alias("exclusivity"),
    )


@_query
def g3_sold_gate(spark: SparkSession, folder: str) -> DataFrame:
    properties = _customers_as_properties(spark, folder)
    return _outcome(gates.sold_gate(_orders_as_rows(spark, folder), properties), "seq")


@_query
def g3_reopen_epochs(spark: SparkSession, folder: str) -> DataFrame:
    rows = _orders_as_rows(spark, folder)
    judged = gates.sold_gate_with_contracts(
        rows.filter(F.col("o_orderpriority") != "1-URGENT").select("property_ID", "seq"),
        rows.filter(F.col("o_orderpriority") == "1-URGENT"),
        _customers_as_properties(spark, folder),
    )
    return _outcome(judged, "seq", "property_ID")


@_query
def g4_date_gate(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]
    # Lines have no number of their own; the gate needs one only to spread them.
    lines = star.read(spark, folder, "lineitem").select(*columns, F.xxhash64(*columns).alias("seq"))
    contracts = star.read(spark, folder, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    judged = gates.appointment_gate(
        lines, contracts, key="l_orderkey", day="l_shipdate", contract_day="o_orderdate"
    )
    return _outcome(judged, "l_orderkey", "l_linenumber", "l_partkey")


@_query
def g5_review_gate(spark: SparkSession, folder: str) -> DataFrame:
    rows = _orders_as_rows(spark, folder)
    sales = rows.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
    judged = gates.review_gate(rows.select("seq", "property_ID", "day"), sales, day="day", sale_day="day")
    return _outcome(judged, "seq")


@_query
def g6_reopen_type(spark: SparkSession, folder: str) -> DataFrame:
    contracts = star.read(spark, folder, "lineitem").withColumnRenamed("l_partkey", "property_ID")
    contracts = within(contracts, "l_shipdate", "1996-01-01", "1997-01-01")
    reopened = effects.reopen(_sold_in_1995(spark, folder), contracts, reopening="ECONOMY")
    return reopened.select("property_ID", "prop_status")


@_query
def g6_final_status(spark: SparkSession, folder: str) -> DataFrame:
    rows = _orders_as_rows(spark, folder)
    return effects.final_status(
        _customers_as_properties(spark, folder),
        rows.filter(F.col("o_orderpriority") != "1-URGENT"),
        rows.filter(F.col("o_orderpriority") == "1-URGENT"),
    )


@_query
def g7_exclusive_gate(spark: SparkSession, folder: str) -> DataFrame:
    rows = _orders_as_rows(spark, folder).select("seq", "day", "exclusivity", "o_orderstatus")
    judged = gates.exclusivity_gate(
        rows.filter(F.col("o_orderstatus") != "F"),
        rows.filter(F.col("o_orderstatus") == "F"),
        scope=["day"],
    )
    return _outcome(judged, "seq")


@_query
def g7_exclusive_gate_empty_store(spark: SparkSession, folder: str) -> DataFrame:
    rows = _orders_as_rows(spark, folder).select("seq", "day", "exclusivity")
    return _outcome(gates.exclusivity_gate(rows, rows.limit(0), scope=["day"]), "seq")


@_query
def g7_exclusive_gate_per_property(spark: SparkSession, folder: str) -> DataFrame:
    rows = _orders_as_rows(spark, folder).withColumn("year", F.year("day"))
    judged = gates.exclusivity_gate(
        rows.filter(F.col("o_orderstatus") != "F").select("seq", "property_ID", "year", "exclusivity"),
        rows.filter(F.col("o_orderstatus") == "F"),
        scope=["property_ID", "year"],
    )
    return _outcome(judged, "seq")


@_query
def g8_reject_messages(spark: SparkSession, folder: str) -> DataFrame:
    properties = _customers_as_properties(spark, folder)
    judged = gates.sold_gate(_orders_as_rows(spark, folder), properties)
    return judged.filter(F.col("reject").isNotNull()).select(
        "seq", gates.sold_message().alias("message")
    )


def _reject_texts(judged: DataFrame, message: Column, *columns: str) -> DataFrame:
    return judged.filter(F.col("reject").isNotNull()).select(*columns, message.alias("message"))


@_query
def g8_appointment_messages(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders_as_rows(spark, folder)
    contracts = orders.filter(F.col("o_orderstatus") == "F").select("property_ID", F.col("day").alias("date_contract"))
    rows = orders.filter(F.col("o_orderstatus") != "F").withColumn("date_appointment", F.col("day"))
    return _reject_texts(gates.appointment_gate(rows, contracts), gates.appointment_message(), "seq")


@_query
def g8_review_messages(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders_as_rows(spark, folder)
    sales = orders.filter("o_orderstatus = 'F' AND exclusivity = 'Yes'").select("property_ID", "day")
    judged = gates.review_gate(orders.withColumn("review_ID", F.col("seq")), sales, day="day", sale_day="day")
    return _reject_texts(judged, gates.review_message(), "seq")


@_query
def g8_exclusivity_messages(spark: SparkSession, folder: str) -> DataFrame:
    rows = _orders_as_rows(spark, folder).withColumn("date_contract", F.to_date("day"))
    stored = rows.filter("o_orderstatus = 'F'").select("date_contract", "exclusivity")
    judged = gates.exclusivity_gate(rows.filter("o_orderstatus != 'F'"), stored)
    return _reject_texts(judged, gates.exclusivity_message(), "seq")


@_query
def g9_judge_sales(spark: SparkSession, folder: str) -> DataFrame:
    """All rules and constraints on a batch of sales: every order, some stored already."""
    orders = star.read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderkey").alias("transaction_ID"),
        F.col("o_custkey").alias("property_ID"),
        F.col("o_custkey").alias("client_ID"),
        F.substring("o_orderpriority", 1, 1).cast("decimal(4,2)").alias("review_process"),
        F.to_date("o_orderdate").alias("date_transaction"),
        "o_orderstatus",
    )
    customers = star.read(spark, folder, "customer")
    tables = {
        "transactions": orders.filter(F.col("o_orderstatus") == "F"),
        "properties": _customers_as_properties(spark, folder),
        "clients": customers.filter(F.col("c_mktsegment") != "MACHINERY").select(
            F.col("c_custkey").alias("client_ID")
        ),
        "agents": star.agents(spark, folder),
    }
    judged = judge("transactions", orders.drop("o_orderstatus"), tables)
    return judged.select("transaction_ID", "accepted", F.array_join("reasons", ",").alias("reasons"))


def _empty_but(spark: SparkSession, **tables: DataFrame) -> dict[str, DataFrame]:
    return {name: empty(spark, table.schema) for name, table in TABLES.items()} | tables


@_query
def g9_judge_bad_seq(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as clients whose arrival numbers are missing or shared by some."""
    customers = star.read(spark, folder, "customer")
    key = F.col("c_custkey")
    batch = customers.select(
        F.when(key % 10 != 0, F.when(key % 10 <= 2, key - key % 10).otherwise(key)).alias("seq"),
        key.alias("client_ID"), F.lit("a").alias("first_name"), F.lit("b").alias("last_name"),
        key.cast("string").alias("contact"),
    )
    judged = judge("clients", batch, _empty_but(spark))
    return judged.select("client_ID", "accepted", F.array_join("reasons", ",").alias("reasons"))


@_query
def k1_k2_judge_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as owners, each three times; the middle one offers a key that is free."""
    key = F.col("c_custkey").cast("int")
    rows = star.read(spark, folder, "customer").withColumn("turn", F.explode(F.array(*map(F.lit, (0, 1, 2)))))
    batch = rows.select(
        (key.cast("long") * 3 + F.col("turn")).alias("seq"),
        # (1, A) is stored; (2, A) loses its contact, so it holds no key; (2, B) is stored.
        (key * 2 + F.when(F.col("turn") == 0, 0).otherwise(1)).alias("owner_ID"),
        F.lit("a").alias("first_name"), F.lit("b").alias("last_name"),
        F.concat(key.cast("string"), F.when(F.col("turn") == 2, "b").otherwise("a")).alias("contact"),
    )
    judged = judge("owners", batch, _empty_but(spark))
    return judged.select("seq", "owner_ID", "accepted", F.array_join("reasons", ",").alias("reasons"))


@_query
def s6_bulk_load(spark: SparkSession, folder: str) -> DataFrame:
    return bulk_load(spark, folder)


# Declared constraints


@_query
def k1_pk_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    lines = star.read(spark, folder, "lineitem")
    return quality.duplicate_keys(lines, ["l_orderkey", "l_linenumber"], null_is_violation=True)


@_query
def k2_unique(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(star.read(spark, folder, "part"), ["p_name"])


@_query
def k3_null_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Customer, order and date of orders; priorities and totals that mean nothing are NULL."""
    orders = star.read(spark, folder, "orders").withColumns(
        {
            "o_orderpriority": F.expr("nullif(o_orderpriority, '4-NOT SPECIFIED')"),
            "o_totalprice": F.expr("CASE WHEN o_totalprice >= 100000 THEN o_totalprice END"),
        }
    )
    return quality.null_profile(orders, ["o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"])


@_query
def k4_check(spark: SparkSession, folder: str) -> DataFrame:
    customers = star.read(spark, folder, "customer")
    return quality.check_violations(customers, "c_acctbal > 0").select("c_custkey", "c_acctbal")


@_query
def k5_check_nullable(spark: SparkSession, folder: str) -> DataFrame:
    lines = star.read(spark, folder, "lineitem")
    rated = lines.withColumn("rating", F.expr("nullif(l_quantity, 1)"))
    return quality.check_violations(rated, "rating > 10").select(
        "l_orderkey", "l_linenumber", "l_partkey", "rating"
    )


@_query
def k6_domain(spark: SparkSession, folder: str) -> DataFrame:
    domain = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
    orders = star.read(spark, folder, "orders")
    return quality.domain_violations(orders, "o_orderpriority", domain).select(
        "o_orderkey", "o_orderpriority"
    )


@_query
def k7_orphans(spark: SparkSession, folder: str) -> DataFrame:
    parents = star.read(spark, folder, "customer").filter(F.col("c_acctbal") > 0)
    return quality.orphans(star.read(spark, folder, "orders"), "o_custkey", parents, "c_custkey")


@_query
def k8_set_null(spark: SparkSession, folder: str) -> DataFrame:
    deleted = star.read(spark, folder, "nation").filter(F.col("n_regionkey") == 0)
    customers = star.read(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return integrity.set_null(customers, "c_nationkey", deleted, "n_nationkey")


def _brokerage_of_nations(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Nations as companies, suppliers as their agents; no other children."""
    nations, suppliers = star.read(spark, folder, "nation"), star.read(spark, folder, "supplier")
    made = {name: empty(spark, table.schema) for name, table in TABLES.items()}
    return made | {
        "companies": nations.select(F.col("n_nationkey").alias("company_ID"), F.col("n_name").alias("comp_name")),
        "agents": suppliers.select(F.col("s_suppkey").alias("agent_ID"), F.col("s_nationkey").alias("company_ID")),
    }


def _changed(changed: dict[str, DataFrame]) -> DataFrame:
    """Companies, and agents with theirs, after a change."""
    companies = changed["companies"].select(
        F.lit("company").alias("kind"), F.col("company_ID").cast("long").alias("id"), F.lit(None).cast("long").alias("company")
    )
    agents = changed["agents"].select(
        F.lit("agent").alias("kind"), F.col("agent_ID").cast("long").alias("id"), F.col("company_ID").cast("long").alias("company")
    )
    return companies.unionByName(agents)


@_query
def k8_delete_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Nations of one region deleted, each named by all its customers."""
    gone = star.read(spark, folder, "nation").filter(F.col("n_regionkey") == 0)
    named = star.read(spark, folder, "customer").select(F.col("c_nationkey").alias("company_ID"))
    named = named.join(gone.select(F.col("n_nationkey").alias("company_ID")), "company_ID", "left_semi")
    return _changed(integrity.delete_rows(_brokerage_of_nations(spark, folder), "companies", named))


@_query
def k9_renumber_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Nations of one region renumbered, each pair given by all its customers."""
    moved = star.read(spark, folder, "nation").filter(F.col("n_regionkey") == 1)
    pairs = star.read(spark, folder, "customer").join(moved, F.col("c_nationkey") == F.col("n_nationkey"))
    pairs = pairs.select(F.col("n_nationkey").alias("old_key"), (F.col("n_nationkey") + 100).alias("new_key"))
    return _changed(integrity.renumber_rows(_brokerage_of_nations(spark, folder), "companies", pairs))


@_query
def k9_cascade(spark: SparkSession, folder: str) -> DataFrame:
    renumbered = (
        star.read(spark, folder, "nation")
        .filter(F.col("n_regionkey") == 1)
        .select(F.col("n_nationkey").alias("old_key"), (F.col("n_nationkey") + 100).alias("new_key"))
    )
    customers = star.read(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return integrity.cascade(customers, "c_nationkey", renumbered)


@_query
def k10_restrict(spark: SparkSession, folder: str) -> DataFrame:
    deleted = star.read(spark, folder, "customer").filter(F.col("c_acctbal") < 0)
    orders = star.read(spark, folder, "orders")
    return integrity.restricting(deleted.select("c_custkey"), "c_custkey", orders, "o_custkey")


@_query
def k11_conformity(spark: SparkSession, folder: str) -> DataFrame:
    parts = star.read(spark, folder, "part")
    name = Field("p_name", parts.schema["p_name"].dataType, length=10)
    bad = quality.nonconforming(name, name.type)
    return parts.filter(bad).select("p_partkey", "p_name")


@_query
def k11_precision(spark: SparkSession, folder: str) -> DataFrame:
    orders = star.read(spark, folder, "orders").withColumn(
        "price", F.col("o_totalprice").cast(star.MONEY)
    )
    size = TABLES["properties"].schema["listing_price"].dataType
    key = Field("o_orderkey", orders.schema["o_orderkey"].dataType, digits=4)
    bad_price = quality.nonconforming(Field("price", size), orders.schema["price"].dataType)
    return orders.select(
        "o_orderkey",
        bad_price.alias("bad_price"),
        quality.nonconforming(key, key.type).alias("bad_key"),
    ).filter("bad_price OR bad_key")


@_query
def k12_ids(spark: SparkSession, folder: str) -> DataFrame:
    orders = star.read(spark, folder, "orders").filter(F.col("o_orderstatus") == "O")
    return ordering.with_ids(orders.select("o_orderkey"), "o_orderkey", "id", 100)


# Sources, predicates, aggregates and functions on their own


@_query
def s1_full_read(spark: SparkSession, folder: str) -> DataFrame:
    return star.read(spark, folder, "supplier")


@_query
def s3_batch_append(spark: SparkSession, folder: str) -> DataFrame:
    orders = star.read(spark, folder, "orders")
    stored, batch = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O"
    return append_rows(orders.filter(stored), orders.filter(batch))


@_query
def s4_subset_append(spark: SparkSession, folder: str) -> DataFrame:
    nations = star.read(spark, folder, "nation")
    return append_rows(nations, nations.select("n_nationkey", "n_name"))


@_query
def s7_view(spark: SparkSession, folder: str) -> DataFrame:
    lines = invoice.invoice_lines(star.brokerage(spark, folder), "NATION_3", CLIENT)
    return _as_double(invoice.define_view("invoice_details", lines), "Price")


@_query
def p4_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return star.read(spark, folder, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@_query
def p6_in_list(spark: SparkSession, folder: str) -> DataFrame:
    orders = star.read(spark, folder, "orders")
    listed = F.col("o_orderstatus").isNotNull() & ~quality.outside("o_orderstatus", ["F", "O"])
    return orders.filter(listed).select("o_orderkey", "o_orderstatus")


@_query
def p7_between(spark: SparkSession, folder: str) -> DataFrame:
    orders = on_days(star.read(spark, folder, "orders"), "o_orderdate", "1997-03-01", "1997-06-30")
    return orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))


@_query
def p8_half_open(spark: SparkSession, folder: str) -> DataFrame:
    lines = within(star.read(spark, folder, "lineitem"), "l_shipdate", "1997-03-01", "1997-07-01")
    return lines.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"))


@_query
def p9_not_null(spark: SparkSession, folder: str) -> DataFrame:
    sales = star.transactions(spark, folder).filter(F.col("review_process").isNotNull())
    return sales.select("transaction_ID", "property_ID", "review_process")


@_query
def p10_exists(spark: SparkSession, folder: str) -> DataFrame:
    customers = star.read(spark, folder, "customer").select("c_custkey", "c_name")
    return integrity.restricting(customers, "c_custkey", star.read(spark, folder, "orders"), "o_custkey")


@_query
def p11_scalar_lookup(spark: SparkSession, folder: str) -> DataFrame:
    nation = star.read(spark, folder, "nation").filter(F.col("n_name") == COMPANY)
    key = nation.select("n_nationkey").scalar()
    return star.read(spark, folder, "customer").filter(F.col("c_nationkey") == key).select("c_custkey")


@_query
def p13_three_valued(spark: SparkSession, folder: str) -> DataFrame:
    """A condition that is unknown neither selects nor rejects."""
    rows = _orders_as_rows(spark, folder)
    exclusive = F.col("exclusivity") == "Yes"
    return rows.filter(exclusive | (~exclusive & (F.col("o_orderstatus") == "P"))).select("seq")


@_query
def j3_sold_and_reviewed(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with a sale and a review, counted without pairing the two."""
    sales = star.transactions(spark, folder).groupBy("property_ID")
    given = star.reviews(spark, folder).groupBy("property_ID")
    return sales.agg(F.count(F.lit(1)).alias("sales")).join(
        given.agg(F.count(F.lit(1)).alias("reviews")), "property_ID"
    )


@_query
def j6_status_lookup(spark: SparkSession, folder: str) -> DataFrame:
    properties = _customers_as_properties(spark, folder).filter(F.col("property_TYPE") == "House")
    rows = _orders_as_rows(spark, folder).select("seq", "property_ID")
    found = spread_join(rows, properties.select("property_ID", "prop_status"), ["property_ID"], "seq")
    return found.select("seq", "prop_status")


@_query
def a4_coalesce_sum(spark: SparkSession, folder: str) -> DataFrame:
    orders = star.read(spark, folder, "orders")
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice").cast(star.MONEY))
    return orders.groupBy("o_custkey").agg(total_or_zero(urgent).cast("double").alias("urgent_total"))


@_query
def a5_conditional_count(spark: SparkSession, folder: str) -> DataFrame:
    rows = _orders_as_rows(spark, folder).withColumn("date_contract", F.to_date("day"))
    return gates.counted_exclusivity(rows)


@_query
def a6_first_date(spark: SparkSession, folder: str) -> DataFrame:
    first = gates.first_contracts(star.contracts_owner(spark, folder))
    return first.select("property_ID", F.to_date("first_contract").alias("first_contract"))


@_query
def o1_top_k(spark: SparkSession, folder: str) -> DataFrame:
    orders = star.read(spark, folder, "orders")
    return reports.largest(orders.select("o_orderkey", "o_totalprice"), 3, "o_totalprice", "o_orderkey")


@_query
def f1_concat(spark: SparkSession, folder: str) -> DataFrame:
    sales = star.read(spark, folder, "orders")
    agents = star.agents(spark, folder)
    note = joined("New transaction added: ", F.col("o_orderkey"))
    names = full_name(F.col("first_name_agent"), F.col("last_name_agent"))
    return sales.select(note.alias("text")).union(agents.select(names))


@_query
def f2_month_label(spark: SparkSession, folder: str) -> DataFrame:
    orders = star.read(spark, folder, "orders")
    return orders.groupBy(month_label(F.to_date("o_orderdate")).alias("month")).agg(
        F.count(F.lit(1)).alias("orders")
    )


def _spans(spark: SparkSession, folder: str) -> DataFrame:
    orders = star.read(spark, folder, "orders")
    return orders.groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("first"),
        F.to_date(F.max("o_orderdate")).alias("last"),
        F.sum(F.col("o_totalprice").cast(star.MONEY)).alias("total"),
    )


@_query
def f3_whole_years(spark: SparkSession, folder: str) -> DataFrame:
    years = whole_years(F.col("first"), F.col("last"))
    return _spans(spark, folder).select("o_custkey", years.alias("years"))


@_query
def f4_whole_months(spark: SparkSession, folder: str) -> DataFrame:
    months = whole_months(F.col("first"), F.col("last"))
    return _spans(spark, folder).select("o_custkey", months.alias("months"))


@_query
def f5_f6_invoice_heads(spark: SparkSession, folder: str) -> DataFrame:
    """Number and date of an invoice for every customer."""
    number = invoice_number(F.lit(COMPANY), F.col("c_custkey"), F.lit(AS_OF))
    return star.read(spark, folder, "customer").select(
        "c_custkey", F.current_date().alias("today"), number.alias("number")
    )


@_query
def f8_decimal_division(spark: SparkSession, folder: str) -> DataFrame:
    average = ratio(F.col("total"), whole_months(F.col("first"), F.col("last")) + 1)
    return _spans(spark, folder).select("o_custkey", average.cast("double").alias("monthly"))


@_query
def f8_long_division(spark: SparkSession, folder: str) -> DataFrame:
    """Exact quotients by 101 and more units."""
    orders = star.read(spark, folder, "orders")
    total = F.col("o_totalprice").cast(star.MONEY)
    return orders.select("o_orderkey", ratio(total, F.col("o_custkey") + 101).cast("string").alias("quotient"))


@_query
def f10_date_literal(spark: SparkSession, folder: str) -> DataFrame:
    orders = star.read(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return orders.filter(F.col("day") == "1997-05-28")


@_query
def f11_rounding(spark: SparkSession, folder: str) -> DataFrame:
    """Values as an insert stores them in a column with one decimal place."""
    events = star.read(spark, folder, "events").withColumn("value", F.col("value").cast(star.MONEY))
    given = events.schema["value"].dataType
    stored = quality.as_stored("value", given, T.DecimalType(17, 1))
    return events.select("event_id", stored.cast("double").alias("rounded"))
