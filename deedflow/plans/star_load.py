"""A whole load of a brokerage from the star schema's tables, under all rules.

Owners, agents and companies come from suppliers and nations, clients from customers,
properties from parts.  Pending orders are contracts on the part with the customer's
number, fulfilled orders its sales, and open orders its appointments, visits and
reviews.  Not every row fits, which is the point: each rule has something to reject.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deedflow.plans.load import QUARANTINE, load_all
from deedflow.session import scratch_folder
from deedflow.sources import star
from deedflow.sources.schema import LOAD_ORDER, TABLES
from deedflow.sources.store import SnapshotStore

# Promotional parts are left out, so their type is outside the domain.
KINDS = {
    "ECONOMY": "House",
    "SMALL": "Apartment",
    "MEDIUM": "Villa",
    "STANDARD": "Duplex",
    "LARGE": "Townhouse",
}


def _kind() -> Column:
    kind = F.col("p_type")
    for part, name in KINDS.items():
        kind = F.when(F.col("p_type") == part, name).otherwise(kind)
    return kind


def star_batches(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    nations, suppliers = star.read(spark, folder, "nation"), star.read(spark, folder, "supplier")
    parts, customers = star.read(spark, folder, "part"), star.read(spark, folder, "customer")
    orders = star.read(spark, folder, "orders")
    orders = orders.withColumn("day", F.to_date("o_orderdate"))

    def having(status: str) -> DataFrame:
        return orders.filter(F.col("o_orderstatus") == status)

    def named(key: str, **columns: Column | str) -> list[Column]:
        made = {n: F.col(c) if isinstance(c, str) else c for n, c in columns.items()}
        return [F.col(key).alias("seq"), *[c.alias(n) for n, c in made.items()]]

    supplier_name = {
        "contact": F.col("s_suppkey").cast("string"),
    }
    urgent = F.col("o_orderpriority") == "1-URGENT"
    exclusivity = F.when(urgent, "Yes").when(F.col("o_orderpriority") != "4-NOT SPECIFIED", "No")
    first, last = F.substring_index("s_name", "#", 1), F.substring_index("s_name", "#", -1)
    return {
        "companies": nations.select(
            *named("n_nationkey", company_ID="n_nationkey", comp_name="n_name", city="n_name")
        ),
        "owners": suppliers.select(
            *named("s_suppkey", owner_ID="s_suppkey", first_name=first, last_name=last, **supplier_name)
        ),
        "properties": parts.select(
            *named(
                "p_partkey",
                property_ID="p_partkey",
                owner_ID="p_size",
                property_TYPE=_kind(),
                prop_status=F.lit("For Sale"),
                city="p_brand",
                size="p_size",
                listing_price=F.round("p_retailprice").cast("decimal(18,0)"),
            )
        ),
        "contracts_owner": having("P").select(
            *named(
                "o_orderkey",
                contract_ID="o_orderkey",
                property_ID="o_custkey",
                date_contract="day",
                exclusivity=exclusivity,
            )
        ),
        "agents": suppliers.select(
            *named(
                "s_suppkey",
                agent_ID="s_suppkey",
                company_ID="s_nationkey",
                first_name_agent=first,
                last_name_agent=last,
                **supplier_name,
            )
        ),
        "clients": customers.select(
            *named(
                "c_custkey",
                client_ID="c_custkey",
                first_name=F.substring_index("c_name", "#", 1),
                last_name=F.substring_index("c_name", "#", -1),
                contact=F.col("c_custkey").cast("string"),
            )
        ),
        "appointments": having("O").select(
            *named(
                "o_orderkey",
                appointment_ID="o_orderkey",
                client_ID="o_custkey",
                property_ID="o_custkey",
                date_appointment="day",
                type_appointment=F.when(urgent, "Meeting").otherwise(""),
            )
        ),
        "transactions": having("F").select(
            *named(
                "o_orderkey",
                transaction_ID="o_orderkey",
                property_ID="o_custkey",
                client_ID="o_custkey",
                date_transaction="day",
            )
        ),
        "visits": having("O").select(
            *named(
                "o_orderkey",
                visit_ID="o_orderkey",
                appointment_id="o_orderkey",
                outcome=F.when(urgent, "Y").otherwise("Waiting"),
            )
        ),
        "reviews": having("O").select(
            *named(
                "o_orderkey",
                review_ID="o_orderkey",
                property_ID="o_custkey",
                client_ID="o_custkey",
                date_review="day",
            )
        ),
    }


def bulk_load(spark: SparkSession, folder: str) -> DataFrame:
    """Load everything into a new store and count what each table kept and rejected."""
    store = SnapshotStore(spark, f"{scratch_folder(spark)}/deedflow/store-{uuid.uuid4().hex}")
    load_all(store, star_batches(spark, folder), QUARANTINE)

    def summary(label: str, kept: DataFrame, key: str, rejected: DataFrame | None) -> DataFrame:
        total = kept.agg(
            F.lit(label).alias("table_name"),
            F.count(F.lit(1)).alias("stored"),
            F.coalesce(F.sum(F.col(key).cast("long")), F.lit(0)).alias("key_sum"),
        )
        left_out = F.lit(0).cast("long")
        if rejected is not None:
            left_out = rejected.agg(F.count(F.lit(1))).scalar()
        return total.withColumn("rejected", left_out)

    sold = store.table("properties").filter(F.col("prop_status") == "Sold")
    parts = [
        summary(name, store.table(name), TABLES[name].key, store.rejected(name))
        for name in LOAD_ORDER
    ]
    parts.append(summary("log_transactions", store.table("log_transactions"), "transaction_id", None))
    parts.append(summary("sold properties", sold, "property_ID", None))
    return reduce(DataFrame.unionByName, parts)
