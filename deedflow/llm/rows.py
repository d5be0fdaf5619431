"""Small helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deedflow.session import note_written, scratch_folder, scratch_scope

NO_ID = (1 << 63) - 1


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that all executors share."""
    return f"{scratch_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"


def written(rows: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and go on from there, so that a lost executor costs a re-read."""
    path = new_folder(rows.sparkSession, label)
    rows.write.option("compression", "zstd").parquet(path)
    note_written(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def distilled(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """:func:`written` for what ``build`` returns; the tables it wrote on the way are removed then."""
    path = new_folder(spark, label)
    with scratch_scope(spark):
        rows = build()
        rows.write.option("compression", "zstd").parquet(path)
    note_written(path)
    return spark.read.schema(rows.schema).parquet(path)


def id_or_last(column: str = "doc_id") -> Column:
    """A null id counts as larger than every other."""
    return F.coalesce(F.col(column), F.lit(NO_ID)).cast("long")
