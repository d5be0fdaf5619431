"""The five sales reports.

``tables`` maps table names to DataFrames with the brokerage columns.  A sale has no
amount of its own; it counts with the listing price of its property.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedflow.functions.dates import on_days, period_label, whole_months, whole_years, within
from deedflow.functions.money import ratio, total_of

Tables = Mapping[str, DataFrame]


def sales_between(tables: Tables, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Who bought what from ``start`` to ``end``, both days included."""
    sales = on_days(tables["transactions"], "date_transaction", start, end)
    return (
        sales.join(tables["clients"], "client_ID")
        .join(tables["properties"], "property_ID")
        .select(
            F.col("first_name").alias("customer_first_name"),
            F.col("last_name").alias("customer_last_name"),
            F.to_date("date_transaction").alias("transaction_date"),
            F.col("property_TYPE").alias("product_or_service"),
        )
    )


def top_customers(tables: Tables, k: int = 3) -> DataFrame:
    """The ``k`` clients with the largest total spent; the smaller id wins a tie.

    Totals are built per client id first, so names are joined to one row per client.
    """
    prices = tables["properties"].select("property_ID", "listing_price")
    spent = (
        tables["transactions"]
        .join(prices, "property_ID")
        .groupBy("client_ID")
        .agg(F.sum("listing_price").alias("total_spent"))
    )
    named = spent.join(tables["clients"], "client_ID")
    return largest(named.select("client_ID", "first_name", "last_name", "total_spent"), k, "total_spent", "client_ID")


def largest(rows: DataFrame, k: int, amount: str, tie: str) -> DataFrame:
    """The ``k`` rows of largest ``amount``, the smaller ``tie`` first."""
    return rows.orderBy(F.desc(amount), tie).limit(k)


def period_summary(tables: Tables, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """One row on the sales from ``start`` on and before ``end``.

    The averages divide by the whole years or months between first and last sale, plus
    one.  Sales are counted per property before the price is joined.
    """
    per_property = (
        within(tables["transactions"], "date_transaction", start, end)
        .groupBy("property_ID")
        .agg(
            F.count(F.lit(1)).alias("sales"),
            F.min("date_transaction").alias("first_sale"),
            F.max("date_transaction").alias("last_sale"),
        )
    )
    whole = per_property.join(
        tables["properties"].select("property_ID", "listing_price"), "property_ID"
    ).agg(
        total_of(F.col("listing_price"), F.col("sales")).alias("total"),
        F.to_date(F.min("first_sale")).alias("first_sale"),
        F.to_date(F.max("last_sale")).alias("last_sale"),
    )
    first, last, total = F.col("first_sale"), F.col("last_sale"), F.col("total")
    return whole.select(
        period_label(first, last).alias("PeriodOfSales"),
        total.alias("TotalSales"),
        ratio(total, whole_years(first, last) + 1).alias("YearlyAverage"),
        ratio(total, whole_months(first, last) + 1).alias("MonthlyAverage"),
    )


def sales_by_city(tables: Tables) -> DataFrame:
    """Total sales per city, counted per property before the city is joined."""
    per_property = (
        tables["transactions"].groupBy("property_ID").agg(F.count(F.lit(1)).alias("sales"))
    )
    places = tables["properties"].select("property_ID", "city", "listing_price")
    return (
        per_property.join(places, "property_ID")
        .groupBy(F.col("city").alias("location"))
        .agg(total_of(F.col("listing_price"), F.col("sales")).alias("total_sales"))
    )


def reviewed_sale_cities(tables: Tables) -> DataFrame:
    """Cities with a property that has a sale with a process rating, and a review."""
    rated = tables["transactions"].filter(F.col("review_process").isNotNull())
    return (
        tables["properties"]
        .join(rated.select("property_ID").distinct(), "property_ID", "left_semi")
        .join(tables["reviews"].select("property_ID").distinct(), "property_ID", "left_semi")
        .select(F.col("city").alias("location"))
        .distinct()
    )
