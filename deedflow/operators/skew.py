"""Joins of per-key state onto rows whose keys may be very unevenly filled.

A plain join of two stored tables is left to Spark, whose adaptive execution splits
an oversized partition at run time.  It cannot do so when one side of the join is an
aggregate, because the aggregate sits between the join and its shuffle.  The joins
here salt the overfull keys instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is dealt out over several tasks.
HOT_ROWS = 200_000
# A key is salted if it also has more than this part of all rows, which bounds the number of
# salted keys and so the broadcast.
HOT_SHARE = 1 / 10_000


def heavy_keys(rows: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Overfull keys with the number of shares to split them into (``_fan``).

    NULL counts as a key of its own.  The count is combined on the map side.
    """
    hot_rows = hot_rows or HOT_ROWS
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    share = counts.agg((F.sum("_rows") * HOT_SHARE).alias("_least")).scalar()
    return counts.filter((F.col("_rows") > hot_rows) & (F.col("_rows") > share)).select(
        *keys, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_fan")
    )


def tag_heavy(rows: DataFrame, heavy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with ``_fan``, NULL where the key is not overfull."""
    renamed = heavy.select(*[F.col(k).alias(f"_heavy_{k}") for k in keys], "_fan")
    match = [F.col(k).eqNullSafe(F.col(f"_heavy_{k}")) for k in keys]
    return rows.join(F.broadcast(renamed), match, "left").drop(*[f"_heavy_{k}" for k in keys])


def spread_join(
    rows: DataFrame,
    state: DataFrame,
    keys: Sequence[str],
    salt_by: str,
    counted: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Left join of ``state`` (one row per key) onto ``rows``.

    Rows of an overfull key are dealt by a hash of ``salt_by`` into shares of about
    ``hot_rows`` rows, and the key's one state row is repeated per share.  ``counted``
    may name a cheaper frame with the same keys to take the counts from.
    """
    counts = heavy_keys(rows if counted is None else counted, keys, hot_rows)
    # HOT_SHARE bounds their number.
    found = counts.collect()
    if not found:
        return rows.join(state, list(keys), "left")
    heavy = rows.sparkSession.createDataFrame(found, counts.schema)
    share = F.when(F.col("_fan").isNull(), 0).otherwise(
        F.pmod(F.xxhash64(salt_by), F.col("_fan")).cast("int")
    )
    shares = F.explode(F.sequence(F.lit(0), F.coalesce("_fan", F.lit(1)) - 1))
    dealt = tag_heavy(rows, heavy, keys).withColumn("_share", share).drop("_fan")
    repeated = tag_heavy(state, heavy, keys).withColumn("_share", shares).drop("_fan")
    return dealt.join(repeated, [*keys, "_share"], "left").drop("_share")
