"""Declared constraints as data-quality reports and row checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deedflow.sources.schema import Field, Table


def duplicate_keys(rows: DataFrame, keys: Sequence[str], null_is_violation: bool = False) -> DataFrame:
    """Keys held by more than one row, with the number of rows.

    A key with a NULL part is never a duplicate; for a primary key it is a violation
    by itself.
    """
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    repeated = (F.col("copies") > 1) & ~has_null
    return counts.filter(repeated | has_null if null_is_violation else repeated)


def null_profile(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the number of NULLs per column, in one pass."""
    return rows.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def check_violations(rows: DataFrame, condition: Column | str) -> DataFrame:
    """Rows on which a CHECK condition is false; NULL passes."""
    return rows.filter(fails(condition))


def fails(condition: Column | str) -> Column:
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return ~F.coalesce(condition, F.lit(True))


def domain_violations(rows: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """Rows whose value is outside the domain; NULL is the not-null check's matter."""
    return rows.filter(outside(column, domain))


def outside(column: str, domain: Sequence[str]) -> Column:
    return fails(F.col(column).isin(list(domain)))


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Values of a foreign key without a parent, with the number of child rows.

    The child is reduced to one row per value before it meets the parent, so an
    overfull value costs no more than any other.
    """
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("child_rows"))
    )
    return values.join(parent.select(F.col(key).alias(column)), column, "left_anti")


def too_long(column: str, length: int) -> Column:
    return F.coalesce(F.length(column) > length, F.lit(False))


def too_many_digits(column: str, given: T.DataType, digits: int) -> Column:
    number = F.col(column)
    if not isinstance(given, T.IntegralType):
        number = number.try_cast("decimal(38,0)")
    return F.coalesce((number >= 10**digits) | (number <= -(10**digits)), F.lit(False))


def loses_value(column: str, given: T.DataType, target: T.DataType) -> Column:
    """True where a value does not survive the cast to the declared type unchanged."""
    if given == target or isinstance(target, T.StringType):
        return F.lit(False)
    value = F.col(column)
    typed = value.try_cast(target)
    changed = typed != value
    if isinstance(given, T.StringType):
        # Text is compared as a number or only parsed, since a plain comparison would
        # fail on text that is neither.
        numeric = isinstance(target, T.NumericType)
        changed = typed != value.try_cast("decimal(38,10)") if numeric else F.lit(False)
    return value.isNotNull() & (typed.isNull() | F.coalesce(changed, F.lit(False)))


def as_stored(column: str, given: T.DataType, target: T.DataType) -> Column:
    """The value as an insert stores it: numbers are rounded to the declared places."""
    value = F.col(column)
    if isinstance(target, T.IntegralType) and not isinstance(given, T.IntegralType):
        value = F.round(value.try_cast("decimal(38,10)"))
    return value.try_cast(target)


def unfit(field: Field, given: T.DataType) -> Column:
    """True where a value cannot be stored at all: unreadable, out of range or too long."""
    bad = F.col(field.name).isNotNull() & as_stored(field.name, given, field.type).isNull()
    if field.digits:
        bad = bad | too_many_digits(field.name, given, field.digits)
    if field.length:
        bad = bad | too_long(field.name, field.length)
    return bad


def nonconforming(field: Field, given: T.DataType) -> Column:
    """True where a value does not fit the declared type, digits or length."""
    bad = loses_value(field.name, given, field.type)
    if field.digits:
        bad = bad | too_many_digits(field.name, given, field.digits)
    if field.length:
        bad = bad | too_long(field.name, field.length)
    return bad


def value_checks(rows: DataFrame, table: Table) -> dict[str, Column]:
    """Reason and condition, true where a value as given fails, per declared column."""
    checks = {}
    for field in table.fields:
        given = rows.schema[field.name].dataType
        if given != field.type or field.digits or field.length:
            checks[f"type:{field.name}"] = unfit(field, given)
        if field.required:
            checks[f"not_null:{field.name}"] = F.col(field.name).isNull()
        if field.domain:
            checks[f"domain:{field.name}"] = outside(field.name, field.domain)
    return checks


def stated_checks(table: Table) -> dict[str, Column]:
    """The same for the table's CHECK conditions, to be applied to typed columns."""
    return {f"check:{name}": fails(condition) for name, condition in table.checks}


def conformity_report(rows: DataFrame, table: Table) -> DataFrame:
    """One row: the number of values per column that do not fit their declaration."""
    return rows.agg(
        *[
            F.count_if(nonconforming(f, rows.schema[f.name].dataType)).alias(f"{f.name}_bad")
            for f in table.fields
        ]
    )
