"""Date predicates, labels and whole-unit differences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_date(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def _literal(rows: DataFrame, name: str, day: dt.date) -> Column:
    # A literal of the column's own type keeps the comparison free of casts on the
    # column, so that it reaches the Parquet scan.
    return F.lit(day).cast(rows.schema[name].dataType)


def on_days(rows: DataFrame, name: str, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Rows dated ``start`` to ``end``, both days included; dates or timestamps."""
    start, end = as_date(start), as_date(end)
    if isinstance(rows.schema[name].dataType, T.DateType):
        return rows.filter(F.col(name).between(_literal(rows, name, start), _literal(rows, name, end)))
    return within(rows, name, start, end + dt.timedelta(days=1))


def within(rows: DataFrame, name: str, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Rows dated from ``start`` on and before ``end``."""
    start, end = as_date(start), as_date(end)
    return rows.filter(
        (F.col(name) >= _literal(rows, name, start)) & (F.col(name) < _literal(rows, name, end))
    )


def whole_years(start: Column, end: Column) -> Column:
    return F.timestamp_diff("YEAR", start, end)


def whole_months(start: Column, end: Column) -> Column:
    """Completed months; 31 January to 29 February is none."""
    return F.timestamp_diff("MONTH", start, end)


def month_label(day: Column) -> Column:
    return F.date_format(day, "MM/yyyy")


def period_label(start: Column, end: Column) -> Column:
    return F.concat(month_label(start), F.lit(" – "), month_label(end))
