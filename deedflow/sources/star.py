"""Brokerage tables as views of a star schema of orders, parts and customers.

A company is a nation, an owner or agent a supplier, a client a customer, a property a
part.  A sale is an order line with its order, a review a purchase event.  A part has a
contract with every nation it was supplied from, dated by the first shipment.  Filters
and column pruning reach the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deedflow.functions.text import joined
from deedflow.sources.tables import LazyTables

MONEY = "decimal(18,2)"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _before_hash(column: str) -> Column:
    return F.substring_index(column, "#", 1)


def _after_hash(column: str) -> Column:
    return F.substring_index(column, "#", -1)


def companies(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "nation").select(
        F.col("n_nationkey").alias("company_ID"),
        F.col("n_name").alias("comp_name"),
        F.col("n_name").alias("city"),
    )


def owners(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("owner_ID"),
        _before_hash("s_name").alias("first_name"),
        _after_hash("s_name").alias("last_name"),
        F.col("s_name").alias("contact"),
    )


def properties(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "part").select(
        F.col("p_partkey").alias("property_ID"),
        F.lit(None).cast("long").alias("owner_ID"),
        F.col("p_type").alias("property_TYPE"),
        F.lit("For Sale").alias("prop_status"),
        joined(F.col("p_brand"), "/", F.col("p_type")).alias("city"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").cast(MONEY).alias("listing_price"),
    )


def contracts_owner(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem")
    suppliers = read(spark, folder, "supplier")
    return (
        lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        .groupBy(F.col("l_partkey").alias("property_ID"), F.col("s_nationkey").alias("company_ID"))
        .agg(F.min("l_shipdate").alias("date_contract"))
    )


def agents(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("agent_ID"),
        F.col("s_nationkey").alias("company_ID"),
        _before_hash("s_name").alias("first_name_agent"),
        _after_hash("s_name").alias("last_name_agent"),
        F.col("s_name").alias("contact"),
    )


def clients(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "customer").select(
        F.col("c_custkey").alias("client_ID"),
        _before_hash("c_name").alias("first_name"),
        _after_hash("c_name").alias("last_name"),
        F.col("c_name").alias("contact"),
        F.col("c_mktsegment").alias("preferred_property_type"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem")
    orders = read(spark, folder, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("transaction_ID"),
        F.col("l_partkey").alias("property_ID"),
        F.col("o_custkey").alias("client_ID"),
        F.col("l_suppkey").alias("agent_ID"),
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("review_process"),
        F.col("o_orderdate").alias("date_transaction"),
    )


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read(spark, folder, "events")
        .filter(F.col("event_type") == "purchase")
        .select(
            F.col("event_id").alias("review_ID"),
            F.col("user_id").alias("property_ID"),
            F.col("value").alias("rating_property"),
            F.col("ts").alias("date_review"),
        )
    )


VIEWS = {
    view.__name__: view
    for view in (
        companies,
        owners,
        properties,
        contracts_owner,
        agents,
        clients,
        transactions,
        reviews,
    )
}


def brokerage(spark: SparkSession, folder: str) -> LazyTables:
    return LazyTables(lambda name: VIEWS[name](spark, folder))
