"""What is kept of each key, so that a batch looks at its own keys instead of whole tables.

Every batch adds a row per key to a log; the logs are dealt by a hash of the key into as many folders as the store was
made with, and only the buckets of a batch's keys are read for it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deedflow.operators import gates
from deedflow.sources.schema import Table

BUCKETS = 16
BUCKET = "bucket"


@dataclass(frozen=True)
class StateLog:
    """Rows per ``key`` taken from the rows of ``table``, and how those of one key fold into one."""

    name: str
    table: str
    key: str
    taken: Callable[[DataFrame, int], DataFrame]
    folded: Callable[[], Sequence[Column]]
    columns: tuple[tuple[str, T.DataType], ...]

    def schema(self, spec: Table) -> T.StructType:
        key = spec.schema[self.key]
        return T.StructType([key, *[T.StructField(name, kind) for name, kind in self.columns]])

    def fold(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(self.key).agg(*self.folded())


def bucket_of(key: str, buckets: int) -> Column:
    """The text is hashed, so that wider types change nothing."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _keyed(rows: DataFrame, key: str) -> DataFrame:
    return rows.filter(F.col(key).isNotNull())


def _status(rows: DataFrame, number: int) -> DataFrame:
    return rows.select("property_ID", "property_TYPE", "prop_status", F.lit(number).cast("long").alias("number"))


def _contract_days(rows: DataFrame, number: int) -> DataFrame:
    return gates.first_contracts(_keyed(rows, "property_ID"))


def _sales(rows: DataFrame, number: int) -> DataFrame:
    return gates.counted_sales(_keyed(rows, "property_ID"))


def _exclusivity(rows: DataFrame, number: int) -> DataFrame:
    return gates.counted_exclusivity(_keyed(rows, "date_contract").filter("exclusivity IS NOT NULL"))


LOGS: dict[str, StateLog] = {
    log.name: log
    for log in (
        # The last status wins; changes of a status leave the kind out.
        StateLog(
            "status",
            "properties",
            "property_ID",
            _status,
            lambda: [
                F.max("property_TYPE").alias("property_TYPE"),
                F.max_by("prop_status", "number").alias("prop_status"),
                F.max("number").alias("number"),
            ],
            (("property_TYPE", T.StringType()), ("prop_status", T.StringType()), ("number", T.LongType())),
        ),
        StateLog(
            "contract_days",
            "contracts_owner",
            "property_ID",
            _contract_days,
            lambda: [F.min("first_contract").alias("first_contract")],
            (("first_contract", T.DateType()),),
        ),
        StateLog(
            "sales",
            "transactions",
            "property_ID",
            _sales,
            lambda: [F.sum("sales").alias("sales"), F.min("sold_on").alias("sold_on")],
            (("sales", T.LongType()), ("sold_on", T.DateType())),
        ),
        StateLog(
            "exclusivity",
            "contracts_owner",
            "date_contract",
            _exclusivity,
            lambda: [F.sum("exclusive").alias("exclusive"), F.sum("open").alias("open")],
            (("exclusive", T.LongType()), ("open", T.LongType())),
        ),
    )
}


def logs_of(table: str) -> list[StateLog]:
    return [log for log in LOGS.values() if log.table == table]
