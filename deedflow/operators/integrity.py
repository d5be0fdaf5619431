"""What deletes and key changes of a parent do to its children."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedflow.operators.quality import duplicate_keys
from deedflow.operators.skew import spread_join
from deedflow.sources.schema import RESTRICT, TABLES, children_of


class IntegrityError(Exception):
    """A change that the declared keys forbid."""


def set_null(child: DataFrame, column: str, deleted: DataFrame, key: str) -> DataFrame:
    """The child with its references to deleted parents set to NULL.

    ``deleted`` holds each key once.
    """
    gone = deleted.select(F.col(key).alias(column), F.lit(True).alias("_gone"))
    spread = child.withColumn("_salt", F.xxhash64(*child.columns))
    columns = [
        F.when(F.col("_gone").isNull(), F.col(c)).alias(c) if c == column else F.col(c)
        for c in child.columns
    ]
    return spread_join(spread, gone, [column], "_salt", counted=child).select(*columns)


def cascade(child: DataFrame, column: str, renumbered: DataFrame) -> DataFrame:
    """The child with references following ``renumbered`` (old_key once each, new_key)."""
    mapping = renumbered.select(F.col("old_key").alias(column), "new_key")
    kept = child.schema[column].dataType
    spread = child.withColumn("_salt", F.xxhash64(*child.columns))
    columns = [
        F.coalesce("new_key", F.col(c)).cast(kept).alias(c) if c == column else F.col(c)
        for c in child.columns
    ]
    return spread_join(spread, mapping, [column], "_salt", counted=child).select(*columns)


def restricting(deleted: DataFrame, key: str, child: DataFrame, column: str) -> DataFrame:
    """The deleted keys that a child still refers to."""
    used = child.select(F.col(column).alias(key)).distinct()
    return deleted.join(used, key, "left_semi")


def delete_rows(
    tables: Mapping[str, DataFrame], parent: str, deleted: DataFrame
) -> dict[str, DataFrame]:
    """The tables changed by deleting the rows of ``parent`` with the keys ``deleted``.

    A key may be given more than once.  Refused with an error, before anything is changed, while a restricting child still
    refers to one of them.
    """
    key = TABLES[parent].key
    deleted = deleted.select(key).distinct()
    _refuse_if_used(tables, parent, deleted)
    changed = {parent: tables[parent].join(deleted, key, "left_anti")}
    for table, reference in children_of(parent):
        if reference.on_delete != RESTRICT:
            child = changed.get(table.name, tables[table.name])
            changed[table.name] = set_null(child, reference.column, deleted, key)
    return changed


def renumber_rows(
    tables: Mapping[str, DataFrame], parent: str, renumbered: DataFrame
) -> dict[str, DataFrame]:
    """The tables changed by giving rows of ``parent`` new keys (old_key, new_key).

    Refused if an old key is NULL or has several new ones, or if new keys are NULL or not
    unique; the same pair may be given more than once.
    """
    key = TABLES[parent].key
    renumbered = renumbered.select("old_key", "new_key").distinct()
    unclear = duplicate_keys(renumbered, ["old_key"], null_is_violation=True)
    if unclear.limit(1).count() or renumbered.filter("new_key IS NULL").limit(1).count():
        raise IntegrityError(f"old keys of {parent} need one new key each")
    _refuse_if_used(tables, parent, renumbered.select(F.col("old_key").alias(key)))
    changed = {parent: cascade(tables[parent], key, renumbered)}
    if duplicate_keys(changed[parent], [key], null_is_violation=True).limit(1).count():
        raise IntegrityError(f"new keys of {parent} are not unique")
    for table, reference in children_of(parent):
        if reference.on_delete != RESTRICT:
            child = changed.get(table.name, tables[table.name])
            changed[table.name] = cascade(child, reference.column, renumbered)
    return changed


def _refuse_if_used(tables: Mapping[str, DataFrame], parent: str, keys: DataFrame) -> None:
    key = TABLES[parent].key
    for table, reference in children_of(parent):
        if reference.on_delete == RESTRICT:
            used = restricting(keys, key, tables[table.name], reference.column)
            if used.limit(1).count():
                raise IntegrityError(f"{table.name}.{reference.column} still refers to {parent}")
