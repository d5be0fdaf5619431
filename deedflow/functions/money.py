"""Exact money arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(total: Column, units: Column, places: int = 4) -> Column:
    """Quotient of money by a count below 10^9, rounded half up to ``places``, 8 at most.

    The types are chosen so that Spark keeps 13 places of the quotient.  It differs from a half of
    the last place by 1 / (2 * 10^places * units) at least, so rounding it once more is exact.
    """
    return F.round(total.cast("decimal(26,2)") / units.cast("decimal(10,0)"), places)


def total_of(price: Column, copies: Column) -> Column:
    """Sum of ``price`` counted ``copies`` times per row."""
    return F.sum(price * copies)


def total_or_zero(amounts: Column) -> Column:
    """Sum of an aggregate's amounts; 0, not NULL, where there are none."""
    return F.coalesce(F.sum(amounts), F.lit(0))
