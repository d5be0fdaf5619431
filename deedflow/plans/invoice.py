"""The two invoice views, for any company and client."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedflow.functions.money import total_or_zero
from deedflow.functions.text import full_name, invoice_number
from deedflow.plans.reports import Tables
from deedflow.session import cut_lineage


def invoice_header(
    tables: Tables,
    company: str,
    client: int,
    as_of: dt.date | None = None,
    random_number: bool = False,
) -> DataFrame:
    """Head and total of a client's invoice; no row without a sold property.

    A property counts once per contract with the company and per sale to the client.
    Both are counted per property before they meet, contracts only for what the client
    bought: the client's sales are read once and written, so that contracts and properties
    are met by a table of known size.
    """
    day: Column = F.current_date() if as_of is None else F.lit(as_of)
    companies = tables["companies"].filter(F.col("comp_name") == company)
    bought = tables["transactions"].filter(F.col("client_ID") == client)
    sales = bought.groupBy("property_ID", "client_ID").agg(F.count(F.lit(1)).alias("sales"))
    sales = cut_lineage(sales, "invoice-sales")
    contracts = (
        tables["contracts_owner"]
        .join(companies.select("company_ID"), "company_ID", "left_semi")
        .join(sales.select("property_ID"), "property_ID", "left_semi")
        .groupBy("property_ID")
        .agg(F.count(F.lit(1)).alias("contracts"))
    )
    sold = tables["properties"].filter(F.col("prop_status") == "Sold")
    clients = tables["clients"].filter(F.col("client_ID") == client)
    copies = F.col("contracts") * F.col("sales")
    totals = (
        sold.select("property_ID", "listing_price")
        .join(contracts, "property_ID")
        .join(sales, "property_ID")
        .groupBy("client_ID")
        .agg(total_or_zero(F.col("listing_price") * copies).alias("total"))
    )
    number = invoice_number(F.lit(company), F.lit(client), day, as_random=random_number)
    return totals.join(clients, "client_ID").select(
        F.lit(company).alias("Company"),
        day.alias("Date"),
        number.alias("Invoice Number"),
        full_name(F.col("first_name"), F.col("last_name")).alias("Customer Name"),
        F.col("total").alias("Total Sales"),
    )


def invoice_lines(tables: Tables, company: str, client: int) -> DataFrame:
    """The client's purchases of properties under contract with the company.

    The company is looked up by name as a scalar: two of one name are an error.
    """
    company_id = (
        tables["companies"].filter(F.col("comp_name") == company).select("company_ID").scalar()
    )
    bought = tables["transactions"].filter(F.col("client_ID") == client)
    contracts = tables["contracts_owner"].filter(F.col("company_ID") == company_id)
    agents = tables["agents"].select("agent_ID", "first_name_agent", "last_name_agent")
    return (
        bought
        .join(
            tables["properties"].select("property_ID", "property_TYPE", "listing_price"),
            "property_ID",
        )
        .join(agents, "agent_ID")
        .join(contracts.select("property_ID"), "property_ID")
        .select(
            F.col("transaction_ID").alias("Transaction"),
            F.col("property_ID").alias("Property ID"),
            F.col("property_TYPE").alias("Type"),
            F.col("listing_price").alias("Price"),
            full_name(F.col("first_name_agent"), F.col("last_name_agent")).alias("Agent"),
        )
    )


def define_view(name: str, rows: DataFrame) -> DataFrame:
    """Register ``rows`` under ``name``, replacing an older definition, and read it."""
    rows.createOrReplaceTempView(name)
    return rows.sparkSession.table(name)
