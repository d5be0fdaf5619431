"""Stores loaded from the star schema's tables, in batches, under the rules, and read back."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deedflow.plans.judge import judge, judge_mixed
from deedflow.plans.load import QUARANTINE, BatchRejected, apply_batch, load_all, reload_all
from deedflow.session import scratch_folder
from deedflow.sources import star
from deedflow.sources.literals import literal_batch
from deedflow.sources.schema import TABLES, tables_with
from deedflow.sources.store import SnapshotStore, empty
from deedflow.sources.tables import LazyTables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Wide enough for the keys of any scale factor.
WIDE = 12


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def new_store(spark: SparkSession, id_digits: int | None = None) -> SnapshotStore:
    return SnapshotStore(spark, f"{scratch_folder(spark)}/deedflow/store-{uuid.uuid4().hex}", id_digits)


def _nothing(spark: SparkSession, id_digits: int = WIDE) -> LazyTables:
    specs = tables_with(id_digits)
    return LazyTables(lambda name: empty(spark, specs[name].schema), specs)


def _owners(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = star.read(spark, folder, "supplier")
    return suppliers.select(
        F.col("s_suppkey").alias("seq"), F.col("s_suppkey").alias("owner_ID"), F.lit("a").alias("first_name"),
        F.lit("b").alias("last_name"), F.col("s_suppkey").cast("string").alias("contact"),
    )


def _clients(spark: SparkSession, folder: str, key: Column | None = None) -> DataFrame:
    key = F.col("c_custkey") if key is None else key
    return star.read(spark, folder, "customer").select(
        F.col("c_custkey").alias("seq"), key.alias("client_ID"), F.lit("a").alias("first_name"),
        F.lit("b").alias("last_name"), key.cast("string").alias("contact"),
    )


def _summary(store: SnapshotStore, step: str, *names: str) -> DataFrame:
    parts = [
        store.table(name).agg(
            F.lit(step).alias("step"),
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("stored"),
            F.coalesce(F.sum(F.col(TABLES[name].key).cast("long")), F.lit(0)).alias("key_sum"),
        )
        for name in names
    ]
    return reduce(DataFrame.unionAll, parts)


@_query
def s5_reload(spark: SparkSession, folder: str) -> DataFrame:
    """A load, a reload that fails at its last table, and one that does not."""
    store = new_store(spark, WIDE)
    names = ("owners", "clients")
    owners, clients = _owners(spark, folder), _clients(spark, folder)
    load_all(store, {"owners": owners, "clients": clients})
    steps = [_summary(store, "loaded", *names)]
    doubled = clients.unionAll(clients.withColumn("seq", -1 - F.col("seq")))
    odd = owners.filter("owner_ID % 2 = 1")
    try:
        reload_all(store, {"owners": odd, "clients": doubled})
    except BatchRejected as refused:
        steps.append(_summary(store, f"refused {refused.reason}", *names))
    reload_all(store, {"owners": odd, "clients": clients.filter("client_ID % 3 = 0")})
    steps.append(_summary(store, "reloaded", *names))
    return reduce(DataFrame.unionAll, steps)


@_query
def s2_literal_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Regions as companies, each by a statement of its own, and suppliers as their agents."""
    store = new_store(spark, WIDE)
    for key, name in star.read(spark, folder, "region").orderBy("r_regionkey").collect():
        apply_batch(store, "companies", literal_batch(spark, "companies", [(key, name, "Town")]))
    suppliers = star.read(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("seq"), F.col("s_suppkey").alias("agent_ID"), (F.col("s_nationkey") % 7).alias("company_ID"),
        F.lit("a").alias("first_name_agent"), F.lit("b").alias("last_name_agent"), F.col("s_name").alias("contact"),
    )
    # Companies 5 and 6 were never stored.
    apply_batch(store, "agents", suppliers, QUARANTINE)
    tables = store.tables()
    return tables["agents"].join(tables["companies"], "company_ID").select("agent_ID", "comp_name", "comission_rate")


def _mixed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """Orders as sales, the urgent and high ones as contracts, on customers as properties."""
    orders = star.read(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate"))
    priority = F.col("o_orderpriority")
    ids = [F.col("o_orderkey").alias("seq"), F.col("o_custkey").alias("property_ID")]
    sales = orders.filter(~priority.isin("1-URGENT", "2-HIGH")).select(
        *ids, F.col("o_orderkey").alias("transaction_ID"), F.col("o_custkey").alias("client_ID"), F.col("day").alias("date_transaction")
    )
    exclusive = F.when(F.col("o_orderkey") % 7 != 0, F.when(F.col("o_orderkey") % 5 == 0, "Yes").otherwise("No"))
    contracts = orders.filter(priority.isin("1-URGENT", "2-HIGH")).select(
        *ids, F.col("o_orderkey").alias("contract_ID"), F.col("day").alias("date_contract"), exclusive.alias("exclusivity")
    )
    customers = star.read(spark, folder, "customer")
    houses = F.col("c_mktsegment").isin("HOUSEHOLD", "BUILDING")
    properties = customers.select(
        F.col("c_custkey").alias("seq"),
        F.col("c_custkey").alias("property_ID"),
        F.when(houses, "House").otherwise("Villa").alias("property_TYPE"),
        F.when(F.col("c_acctbal") < 0, "Sold").otherwise("For Sale").alias("prop_status"),
        F.lit("a").alias("city"),
        F.lit(1).alias("size"),
        F.lit(1).alias("listing_price"),
    )
    clients = _clients(spark, folder).join(customers.filter("c_mktsegment != 'MACHINERY'"), F.col("client_ID") == F.col("c_custkey"), "left_semi")
    return sales, contracts, {"properties": properties, "clients": clients}


@_query
def g9_judge_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """Contracts between sales: those that are stored reopen houses for later sales."""
    sales, contracts, held = _mixed(spark, folder)
    judged = judge_mixed(sales, contracts, _nothing(spark) | {name: rows.drop("seq") for name, rows in held.items()})
    return reduce(
        DataFrame.unionAll,
        [
            rows.select(
                F.lit(name).alias("table_name"), F.col(TABLES[name].key).alias("id"), "accepted", F.array_join("reasons", ",").alias("reasons")
            )
            for name, rows in judged.items()
        ],
    )


@_query
def g9_apply_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """The same stored in two batches: the status of every property, with its kept first contract and sales."""
    sales, contracts, held = _mixed(spark, folder)
    store = new_store(spark, WIDE)
    load_all(store, held)
    for first, last in (("1900-01-01", "1997-01-01"), ("1997-01-01", "9999-01-01")):
        apply_batch(
            store,
            "transactions",
            sales.filter((F.col("date_transaction") >= first) & (F.col("date_transaction") < last)),
            QUARANTINE,
            contracts=contracts.filter((F.col("date_contract") >= first) & (F.col("date_contract") < last)),
        )
    tables = store.tables()
    written = tables["log_transactions"].select(F.col("transaction_id").alias("logged_ID"))
    logged = written.join(tables["transactions"], F.col("logged_ID") == F.col("transaction_ID"))
    logged = logged.groupBy("property_ID").agg(F.count(F.lit(1)).alias("logged"))
    rows = tables["properties"].select("property_ID", "prop_status")
    for part in (store.state("contract_days"), store.state("sales"), logged):
        rows = rows.join(part, "property_ID", "left")
    return rows.select("property_ID", "prop_status", "first_contract", "sold_on", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("sales", "logged")])


@_query
def a5_a6_kept_state(spark: SparkSession, folder: str) -> DataFrame:
    """Contracts stored half a year at a time: exclusive and open ones per day as kept, and as rows."""
    _, contracts, held = _mixed(spark, folder)
    store = new_store(spark, WIDE)
    load_all(store, {"properties": held["properties"]})
    for months in ("<= 6", "> 6"):
        apply_batch(store, "contracts_owner", contracts.filter(f"month(date_contract) {months}"), QUARANTINE)
    store.compact("contracts_owner")
    rows = store.table("contracts_owner").groupBy("date_contract").agg(F.count(F.lit(1)).alias("stored"))
    return rows.join(store.state("exclusivity"), "date_contract", "left").select(
        "date_contract", "stored", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("exclusive", "open")]
    )


@_query
def k1_k2_judge_chains(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as owners, each 50 times in a chain: every row shares a key with the one before it."""
    key, step = F.col("c_custkey").cast("long"), F.col("step").cast("long")
    # A small file is read by few tasks; its rows are dealt out before they become fifty times as many.
    customers = star.read(spark, folder, "customer").select("c_custkey").repartition(4 * spark.sparkContext.defaultParallelism)
    rows = customers.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(49))))
    batch = rows.select(
        (key * 50 + step).alias("seq"),
        (key * 30 + F.floor((step + 1) / 2)).alias("owner_ID"),
        F.lit("a").alias("first_name"),
        F.lit("b").alias("last_name"),
        (key * 30 + F.floor(step / 2)).cast("string").alias("contact"),
    )
    judged = judge("owners", batch, _nothing(spark))
    return judged.select("seq", "owner_ID", "accepted", F.array_join("reasons", ",").alias("reasons"))


@_query
def k11_wide_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in a store with ids as declared, and once more with longer ids after it was widened."""
    store = new_store(spark)
    apply_batch(store, "clients", _clients(spark, folder).filter("client_ID < 1000000"))
    store.widen(10)
    longer = _clients(spark, folder, F.col("c_custkey") + 5_000_000_000)
    apply_batch(store, "clients", longer, QUARANTINE)
    again = SnapshotStore(spark, store.root)
    return again.table("clients").select("client_ID", "contact")
