"""Rows and updates derived from accepted rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedflow.functions.text import joined
from deedflow.operators.ordering import with_ids


def audit_log(
    sales: DataFrame,
    key: str = "transaction_ID",
    day: str = "date_transaction",
    seq: str = "seq",
    last_id: int = 0,
) -> DataFrame:
    """One log row per accepted sale, numbered in arrival order after ``last_id``."""
    numbered = with_ids(sales.select(*dict.fromkeys((key, day, seq))), seq, "log_ID", last_id)
    return numbered.select(
        "log_ID",
        F.to_date(day).alias("event_date"),
        F.col(key).alias("transaction_id"),
        F.lit("Transaction Inserted").alias("event_type"),
        joined("New transaction added: ", F.col(key)).alias("details"),
    )


SOLD, FOR_SALE, HOUSE = "Sold", "For Sale", "House"


def sold_keys(sales: DataFrame, key: str = "property_ID") -> DataFrame:
    """The properties that accepted sales mark as sold, once each."""
    return sales.filter(F.col(key).isNotNull()).select(key).distinct()


def reopened_keys(
    properties: DataFrame,
    contracts: DataFrame,
    key: str = "property_ID",
    kind: str = "property_TYPE",
    reopening: str = HOUSE,
) -> DataFrame:
    """The houses that accepted contracts put up for sale, once each."""
    touched = contracts.filter(F.col(key).isNotNull()).select(key).distinct()
    return touched.join(properties.filter(F.col(kind) == reopening), key, "left_semi")


def openings(
    properties: DataFrame,
    contracts: DataFrame,
    key: str = "property_ID",
    kind: str = "property_TYPE",
    seq: str = "seq",
    reopening: str = HOUSE,
) -> DataFrame:
    """Property and ``seq`` of the accepted contracts that put a house up for sale."""
    houses = properties.filter(F.col(kind) == reopening).select(key)
    return contracts.filter(F.col(key).isNotNull()).select(key, seq).join(houses, key, "left_semi")


def changed_status(
    sales: DataFrame, opened: DataFrame, key: str = "property_ID", status: str = "prop_status", seq: str = "seq"
) -> DataFrame:
    """The properties that accepted sales and openings touch, once each, with the status that the last of them leaves."""
    events = sales.filter(F.col(key).isNotNull()).select(key, seq, F.lit(SOLD).alias(status)).unionByName(
        opened.select(key, seq, F.lit(FOR_SALE).alias(status))
    )
    return events.groupBy(key).agg(F.max_by(status, seq).alias(status))


def _with_status(
    properties: DataFrame,
    touched: DataFrame,
    key: str,
    status: str,
    value: str,
    condition: Column | None = None,
) -> DataFrame:
    hits = touched.select(key).distinct().withColumn("_hit", F.lit(True))
    hit = F.col("_hit") if condition is None else F.col("_hit") & condition
    columns = [
        F.when(hit, value).otherwise(F.col(c)).alias(c) if c == status else F.col(c)
        for c in properties.columns
    ]
    return properties.join(hits, key, "left").select(*columns)


def mark_sold(
    properties: DataFrame,
    sales: DataFrame,
    key: str = "property_ID",
    status: str = "prop_status",
    sold: str = SOLD,
) -> DataFrame:
    """The properties with every one that has an accepted sale set to sold."""
    return _with_status(properties, sales, key, status, sold)


def reopen(
    properties: DataFrame,
    contracts: DataFrame,
    key: str = "property_ID",
    status: str = "prop_status",
    kind: str = "property_TYPE",
    reopening: str = HOUSE,
    for_sale: str = FOR_SALE,
) -> DataFrame:
    """The properties with every house that has an accepted contract put up for sale."""
    return _with_status(properties, contracts, key, status, for_sale, F.col(kind) == reopening)


def final_status(
    properties: DataFrame,
    sales: DataFrame,
    contracts: DataFrame,
    key: str = "property_ID",
    status: str = "prop_status",
    kind: str = "property_TYPE",
    seq: str = "seq",
    sold: str = SOLD,
    reopening: str = HOUSE,
    for_sale: str = FOR_SALE,
) -> DataFrame:
    """The properties after sales and contracts that arrived mixed, in order of ``seq``.

    The last event decides: a sale leaves the property sold, a contract leaves a house
    for sale and any other property as it was.
    """
    last_sale = sales.groupBy(key).agg(F.max(seq).alias("_sale"))
    last_contract = contracts.groupBy(key).agg(F.max(seq).alias("_contract"))
    contracted = F.when(F.col(kind) == reopening, F.col("_contract"))
    last = F.greatest(F.col("_sale"), contracted)
    value = (
        F.when(last.isNull(), F.col(status))
        .when(last == F.col("_sale"), sold)
        .otherwise(for_sale)
    )
    columns = [value.alias(c) if c == status else F.col(c) for c in properties.columns]
    return (
        properties.join(last_sale, key, "left").join(last_contract, key, "left").select(*columns)
    )
