"""Rules that reject rows of an incoming batch, as joins against per-key state.

Each gate returns the batch with a ``reject`` column: a reason code, or NULL for a
row that passes.  ``seq`` is the arrival number.  ``storable`` names a boolean column
marking the rows that may be stored at all: only those are seen by later rows.
``counted`` may name a cheaper frame with the batch's keys, to find overfull keys in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedflow.functions.text import joined
from deedflow.operators.ordering import with_previous
from deedflow.operators.skew import spread_join

ALREADY_SOLD = "already_sold"
BEFORE_CONTRACT = "appointment_before_contract"
BEFORE_SALE = "review_before_sale"
AMBIGUOUS_SALE = "ambiguous_sale"
EXCLUSIVITY_CLASH = "exclusivity_clash"

# The epoch of sales before any reopening.
NEVER = -(1 << 63)


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _storable(column: str, storable: str | None) -> Column:
    return F.when(F.col(storable), F.col(column)) if storable else F.col(column)


def _touched(stored: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The stored rows whose key is in the batch; others need not be aggregated."""
    return stored.join(batch.select(*keys).distinct(), list(keys), "left_semi")


def sold_gate(
    batch: DataFrame,
    properties: DataFrame,
    key: str = "property_ID",
    status: str = "prop_status",
    seq: str = "seq",
    sold: str = "Sold",
    storable: str | None = None,
    counted: DataFrame | None = None,
    hot_rows: int | None = None,
    epoch: str | None = None,
) -> DataFrame:
    """Reject sales of a property that is sold already, or by an earlier row.

    The first sale of a property that is not sold passes and sells it.  Rows whose
    property is NULL or unknown pass.  ``epoch`` may name a column that tells what reopened
    the property last before the row (see :func:`with_epochs`): the sale then competes with
    those of its epoch, and only before any reopening with the stored status.
    """
    keys = [key, epoch] if epoch else [key]
    first = (
        batch.filter(F.col(key).isNotNull())
        .groupBy(*keys)
        .agg(F.min(_storable(seq, storable)).alias("_first"), F.max(seq).alias("_last"))
    )
    sold_before = F.col("_status") == sold
    if epoch:
        sold_before &= F.col(epoch) == NEVER
    # Properties with nothing to reject are left out of the join.
    state = (
        first.join(properties.select(key, F.col(status).alias("_status")), key, "inner")
        .withColumn("_sold", _true(sold_before))
        .filter(F.col("_sold") | (F.col("_last") > F.col("_first")))
        .select(*keys, "_first", "_sold")
    )
    rejected = _true(F.col("_sold")) | _true(F.col(seq) > F.col("_first"))
    return (
        spread_join(batch, state, keys, seq, counted, hot_rows)
        .withColumn("reject", F.when(rejected, ALREADY_SOLD))
        .drop("_first", "_sold")
    )


def with_epochs(
    sales: DataFrame,
    openings: DataFrame,
    name: str,
    key: str = "property_ID",
    seq: str = "seq",
    hot_rows: int | None = None,
) -> DataFrame:
    """``sales`` with the ``seq`` of the last opening of their property before them, else ``NEVER``.

    ``openings`` are the contracts that put a property up for sale again.
    """
    events = sales.withColumn("_opening", F.lit(None).cast("long")).unionByName(
        openings.select(key, seq, F.col(seq).alias("_opening"), F.lit(True).alias("_opens")), allowMissingColumns=True
    )
    chained = with_previous(events, key, seq, "_opening", name, hot_rows).filter("_opens IS NULL")
    return chained.withColumn(name, F.coalesce(name, F.lit(NEVER))).drop("_opening", "_opens")


def sold_gate_with_contracts(
    sales: DataFrame,
    contracts: DataFrame,
    properties: DataFrame,
    key: str = "property_ID",
    status: str = "prop_status",
    kind: str = "property_TYPE",
    seq: str = "seq",
    sold: str = "Sold",
    reopening: str = "House",
    hot_rows: int | None = None,
) -> DataFrame:
    """``sold_gate`` where contracts arrive between the sales, in one order of ``seq``.

    A contract on a house puts it up for sale again.  A sale, stored or rejected,
    always leaves its property sold, so a sale passes exactly if the event before it
    is such a contract, or if it is the first event and the property was not sold.
    """
    houses = properties.filter(F.col(kind) == reopening).select(key)
    openings = contracts.select(key, seq).join(houses, key, "left_semi")
    events = sales.withColumn("_sale", F.lit(True)).unionByName(
        openings.withColumn("_sale", F.lit(False)), allowMissingColumns=True
    )
    chained = with_previous(events, key, seq, "_sale", "_after_sale", hot_rows)
    sold_before = F.coalesce("_after_sale", F.col("_status") == sold)
    rejected = F.col("_status").isNotNull() & sold_before
    return (
        chained.filter("_sale")
        .join(properties.select(key, F.col(status).alias("_status")), key, "left")
        .withColumn("reject", F.when(_true(rejected), ALREADY_SOLD))
        .drop("_sale", "_status", "_after_sale")
    )


def appointment_gate(
    batch: DataFrame,
    contracts: DataFrame,
    key: str = "property_ID",
    day: str = "date_appointment",
    contract_day: str = "date_contract",
    seq: str = "seq",
    counted: DataFrame | None = None,
    hot_rows: int | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Reject appointments not after the property's first contract day.

    A property without a contract has nothing to compare with, so its rows pass.
    ``state`` may give the first days (``first_contract``), if they are kept.
    """
    if state is None:
        state = first_contracts(_touched(contracts, batch, [key]), key, contract_day)
    return (
        spread_join(batch, state.select(key, "first_contract"), [key], seq, counted, hot_rows)
        .withColumn("reject", F.when(_true(F.col(day) <= F.col("first_contract")), BEFORE_CONTRACT))
        .drop("first_contract")
    )


def first_contracts(contracts: DataFrame, key: str = "property_ID", day: str = "date_contract") -> DataFrame:
    return contracts.groupBy(key).agg(F.min(day).alias("first_contract"))


def review_gate(
    batch: DataFrame,
    sales: DataFrame,
    key: str = "property_ID",
    day: str = "date_review",
    sale_day: str = "date_transaction",
    seq: str = "seq",
    counted: DataFrame | None = None,
    hot_rows: int | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Reject reviews not after the sale of the property.

    The rule needs the one sale of the property: none passes, several are ambiguous.
    ``state`` may give number and first day of the sales (``sales``, ``sold_on``), if they are kept.
    """
    if state is None:
        state = counted_sales(_touched(sales, batch, [key]), key, sale_day)
    state = state.select(key, F.col("sales").alias("_sales"), F.col("sold_on").alias("_sold_on"))
    return (
        spread_join(batch, state, [key], seq, counted, hot_rows)
        .withColumn(
            "reject",
            F.when(F.col("_sales") > 1, AMBIGUOUS_SALE).when(
                F.col(day) <= F.col("_sold_on"), BEFORE_SALE
            ),
        )
        .drop("_sales", "_sold_on")
    )


def counted_sales(sales: DataFrame, key: str = "property_ID", day: str = "date_transaction") -> DataFrame:
    return sales.groupBy(key).agg(F.count(F.lit(1)).alias("sales"), F.min(day).alias("sold_on"))


def exclusivity_gate(
    batch: DataFrame,
    contracts: DataFrame,
    scope: Sequence[str] = ("date_contract",),
    exclusivity: str = "exclusivity",
    seq: str = "seq",
    storable: str | None = None,
    counted: DataFrame | None = None,
    hot_rows: int | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Reject contracts that clash over exclusivity with stored or earlier ones.

    Within the scope (the contract date, as the rule is written) an exclusive contract
    blocks every later one, and a non-exclusive one blocks later exclusive ones.  So
    of the batch only the first row with a known exclusivity decides: if exclusive, it
    blocks all after it; if not, it blocks the exclusive ones.  ``state`` may give the
    numbers of stored contracts (``exclusive``, ``open``), if they are kept.
    """
    scope = list(scope)
    known = _storable(seq, storable)
    known = F.when(F.col(exclusivity).isNotNull(), known)
    arriving = batch.groupBy(*scope).agg(
        F.min(known).alias("_first"),
        F.min_by(F.col(exclusivity) == "Yes", known).alias("_first_yes"),
    )
    if state is None:
        state = counted_exclusivity(_touched(contracts, batch, scope), scope, exclusivity)
    stored = state.select(*scope, F.col("exclusive").alias("_yes"), F.col("open").alias("_no"))
    state = arriving.join(stored, scope, "left").na.fill(0, ["_yes", "_no"])
    wanted = F.col(exclusivity) == "Yes"
    later = F.col(seq) > F.col("_first")
    rejected = (
        _true(F.col("_yes") > 0)
        | _true((F.col("_no") > 0) & wanted)
        | _true((F.col("_no") == 0) & F.col("_first_yes") & later)
        | _true(~F.col("_first_yes") & wanted & later)
    )
    return (
        spread_join(batch, state, scope, seq, counted, hot_rows)
        .withColumn("reject", F.when(rejected, EXCLUSIVITY_CLASH))
        .drop("_first", "_first_yes", "_yes", "_no")
    )


def counted_exclusivity(
    contracts: DataFrame, scope: Sequence[str] = ("date_contract",), exclusivity: str = "exclusivity"
) -> DataFrame:
    return contracts.groupBy(*scope).agg(
        F.count_if(F.col(exclusivity) == "Yes").alias("exclusive"), F.count_if(F.col(exclusivity) == "No").alias("open")
    )


# The texts are fixed values; `reject` is the gate's reason column.


def sold_message(key: str = "property_ID") -> Column:
    return joined(
        "Cannot perform a transaction on Property ID: ", F.col(key), " that is already sold."
    )


def appointment_message() -> Column:
    return F.lit("Date of appointment must be after the contract owner date for the property.")


def review_message(key: str = "review_ID") -> Column:
    late = joined("Review ID: ", F.col(key), " - Review date must be after transaction date.")
    ambiguous = F.lit("The property has more than one transaction to compare with.")
    return F.when(F.col("reject") == AMBIGUOUS_SALE, ambiguous).otherwise(late)


def exclusivity_message() -> Column:
    return F.lit(
        "Cannot set exclusivity if contracts without exclusivity exist for the same date, "
        "or property with exclusivity by another company on the same date."
    )
