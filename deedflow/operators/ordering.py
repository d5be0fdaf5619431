"""Arrival order: the previous row of a key, and dense ids, without one-task windows.

``seq`` is an integer column, unique within the frame.  A window over a whole key or
a whole frame would be one task, so rows are cut into blocks of consecutive ``seq``
values and the blocks are chained through their small summaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from deedflow.operators.skew import HOT_ROWS, heavy_keys
from deedflow.session import cut_lineage

BLOCK_BITS = 16
# An overfull key is cut into so many blocks.
MAX_BLOCKS = 256


def with_previous(
    rows: DataFrame, key: str, seq: str, value: str, name: str, hot_rows: int | None = None
) -> DataFrame:
    """``rows`` with the last ``value`` that is not NULL before them in their key, by ``seq``.

    Rows with a NULL key have no row before them.  The sequence numbers of an overfull key
    are cut at quantiles into ``MAX_BLOCKS`` blocks, however sparse they are, and each
    block is handed the last value of the blocks before it.  The quantiles are
    approximate: they only decide where blocks end, not what is found.
    """
    hot_rows = hot_rows or HOT_ROWS
    # Rows without a key are spread out, as nothing comes before them.
    alone = F.when(F.col(key).isNull(), F.col(seq))
    heavy = cut_lineage(heavy_keys(rows.filter(F.col(key).isNotNull()), [key], hot_rows), "previous-heavy")
    if heavy.isEmpty():
        return rows.withColumn(name, _last_before(value, Window.partitionBy(key, alone).orderBy(seq)))
    # Overfull keys are few by HOT_SHARE, and their cuts of bounded length.
    hot = rows.join(F.broadcast(heavy), key)
    points = F.array(*[F.lit(i / MAX_BLOCKS) for i in range(1, MAX_BLOCKS)])
    cuts = hot.groupBy(key).agg(F.percentile_approx(seq, points, F.lit(10 * MAX_BLOCKS)).alias("_cuts"))
    cuts = cut_lineage(cuts, "previous-cuts")
    block = F.when(F.col(key).isNull(), F.col(seq)).when(
        F.col("_cuts").isNotNull(), F.expr(f"size(filter(_cuts, c -> c < {seq}))")
    )
    blocks = rows.join(F.broadcast(cuts), key, "left")
    blocks = blocks.withColumn("_block", F.coalesce(block, F.lit(0)).cast("long")).drop("_cuts")
    handed = (
        blocks.join(F.broadcast(cuts.select(key)), key, "left_semi")
        .groupBy(key, "_block")
        .agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(seq))).alias("_last"))
        .select(key, "_block", _last_before("_last", Window.partitionBy(key).orderBy("_block")).alias("_handed"))
    )
    inside = Window.partitionBy(key, "_block").orderBy(seq)
    return (
        blocks.join(handed, [key, "_block"], "left")
        .withColumn(name, F.coalesce(_last_before(value, inside), "_handed"))
        .drop("_block", "_handed")
    )


def _last_before(column: str, window: WindowSpec) -> Column:
    return F.last(column, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))


def _before(count: str, within: str | None, order: str) -> Column:
    window = Window.partitionBy(within) if within else Window.partitionBy()
    running = F.sum(count).over(
        window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return running - F.col(count)


def with_ids(rows: DataFrame, seq: str, name: str, start: int = 0) -> DataFrame:
    """``rows`` numbered ``start + 1, start + 2, ...`` in the order of ``seq``.

    Blocks of 2^16 sequence numbers are counted, their counts summed up over three
    levels of 2^16 blocks each, and the rows numbered inside their block.  No window
    partition exceeds 2^16 rows, whatever the frame's size: three levels cover 64 bits.
    """
    missing = F.raise_error(F.lit("rows to be numbered need a seq"))
    rows = rows.withColumn(seq, F.coalesce(F.col(seq), missing.cast(rows.schema[seq].dataType)))
    levels = [f"_level{i}" for i in range(3)]
    # The counts of blocks are small and used on all three levels.
    counts = rows.groupBy(
        *[F.shiftright(F.col(seq).cast("long"), BLOCK_BITS * (i + 1)).alias(level)
          for i, level in enumerate(levels)]
    ).agg(F.count(F.lit(1)).alias("_count"))
    counts = cut_lineage(counts, "id-blocks")
    middle = counts.groupBy(levels[1], levels[2]).agg(F.sum("_count").alias("_middle"))
    top = middle.groupBy(levels[2]).agg(F.sum("_middle").alias("_top"))

    top = top.select(levels[2], _before("_top", None, levels[2]).alias("_before2"))
    middle = middle.select(
        levels[1], levels[2], _before("_middle", levels[2], levels[1]).alias("_before1")
    )
    offsets = (
        counts.withColumn("_before0", _before("_count", levels[1], levels[0]))
        .join(middle, levels[1:], "inner")
        .join(top, levels[2], "inner")
        .select(levels[0], (F.col("_before0") + F.col("_before1") + F.col("_before2")).alias("_offset"))
    )
    inside = Window.partitionBy(levels[0]).orderBy(seq)
    return (
        rows.withColumn(levels[0], F.shiftright(F.col(seq).cast("long"), BLOCK_BITS))
        .join(offsets, levels[0], "inner")
        .withColumn(name, (F.lit(start) + F.col("_offset") + F.row_number().over(inside)).cast("long"))
        .drop(levels[0], "_offset")
    )
