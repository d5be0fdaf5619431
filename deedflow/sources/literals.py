"""Small literal batches, as typed in by hand."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deedflow.sources.schema import TABLES


def literal_batch(
    spark: SparkSession,
    table: str,
    rows: Sequence[Sequence],
    columns: Sequence[str] | None = None,
    types: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """Rows of one insert with their arrival number ``seq``.

    ``columns`` names the columns given; the others are NULL.  ``types`` overrides
    declared types, for input that does not conform to them.
    """
    spec = TABLES[table]
    columns = list(columns or spec.columns)
    declared = {f.name: (types or {}).get(f.name, f.type) for f in spec.fields}
    given = T.StructType(
        [T.StructField("seq", T.LongType(), False)]
        + [T.StructField(c, declared[c], True) for c in columns]
    )
    numbered = [(i, *row) for i, row in enumerate(rows, start=1)]
    return fill_columns(spark.createDataFrame(numbered, given), declared)


def fill_columns(rows: DataFrame, declared: Mapping[str, T.DataType]) -> DataFrame:
    """``rows`` with every declared column, NULL where it has none, then the others.

    Names are compared without regard to case, as Spark does, and come out as declared.
    """
    present = {c.lower() for c in rows.columns}
    known = {c.lower() for c in declared}
    return rows.select(
        *[(F.col(c) if c.lower() in present else F.lit(None).cast(t)).alias(c) for c, t in declared.items()],
        *[c for c in rows.columns if c.lower() not in known],
    )


def append_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` after ``table``; columns missing on one side are NULL there."""
    return table.unionByName(rows, allowMissingColumns=True)
