"""Text built from columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(*parts: Column | str) -> Column:
    """Concatenation of columns and plain strings; NULL if any column is NULL."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def full_name(first: Column, last: Column) -> Column:
    return joined(first, " ", last)


def invoice_number(*parts: Column, as_random: bool = False) -> Column:
    """Number from 0 to 99999: from an md5 of the invoice's keys, or drawn at each read."""
    if as_random:
        return F.floor(F.rand() * 100000)
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100000
