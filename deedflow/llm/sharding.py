"""Shards of near equal bytes by a k-d tree over document metadata.

A node that is to hold ``n`` shards is cut along its widest dimension, where the bytes before the cut
come nearest to the share of ``n // 2`` shards, until every leaf is one shard.  Dimensions are
integers of comparable range; the widest is the one with the largest distance between the node's 1/8
and 7/8 points.  The weighted medians of a level's nodes are found together by histograms of
``BINS`` ranges, refined until the range that holds the cut is light or one value.  A heavy value is
cut along the texts' hash, and a heavy text along the ids' hash.  So equal texts, which agree in
all dimensions, part only if their group weighs more than ``GROUP`` of a shard.

Copies of a text take the smallest metadata values of their group.

Nodes, ranges and cuts are small tables that rows are joined with, whatever the number of shards.  What reaches the
driver are the nodes, as many as shards, and histograms of ``MOST_RANGES`` ranges in all.
Slots are numbered in blocks of about ``BLOCK_ROWS`` rows, counted first; no window holds a shard.

Defined results: a null text is empty, a null metadata value is 0; a null id ranks last; rows equal
in id and text stay in one shard, in any order; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from deedflow.llm.rows import id_or_last, new_folder, written
from deedflow.session import note_written, remove_folder

SIZE_EXTRA = 16
BINS, MOST_RANGES = 1024, 1 << 20
# A cut may miss its place by this part of a shard's bytes, and by GROUP to keep equal texts together.
TOLERANCE, GROUP = 1 / 1000, 1 / 50
BLOCK_ROWS = 50_000
_TOP = (1 << 62) - 1
_TIES = ("_text", "_row")


def default_dimensions() -> dict[str, Column]:
    """Length (logarithm), language and source, each on a scale of 20 bits."""
    return {
        "length": F.log2(F.length("text") + F.lit(1.0)) * (1 << 15),
        "lang": F.shiftright(F.crc32(F.col("lang").cast("string")), 12),
        "source": F.shiftright(F.crc32(F.col("source").cast("string")), 12),
    }


@dataclass
class Node:
    """``shards`` shards from ``first`` on; rows below ``cut``, by the dimension ``widest`` and the ties, go left."""

    first: int
    shards: int
    widest: int = 0
    cut: tuple[int, ...] = ()


@dataclass
class _Search:
    """The cut of one node lies between ``low`` and ``high`` of a key, with ``before`` bytes below.

    The first key is the node's widest dimension; values ``fixed`` of it, and of the texts' hash, lead to the next.
    """

    node: Node
    goal: float
    low: int
    high: int
    before: int = 0
    fixed: tuple[int, ...] = ()

    def row(self, bins: int) -> tuple:
        width = max(1, -(-(self.high - self.low + 1) // bins))
        return (self.node.first, self.node.widest, len(self.fixed), *(*self.fixed, 0, 0)[:2], self.low, self.high, width)

    def narrow(self, histogram: dict[int, Row], target: float) -> bool:
        """Go on inside the range that holds the goal; True once the cut is set."""
        for b in sorted(histogram):
            found = histogram[b]
            if self.before + found["size"] > self.goal:
                break
            self.before += found["size"]
        else:
            self.before -= found["size"]
        self.low, self.high = found["low"], found["high"]
        one_text = len(self.fixed) == 1 and self.low == self.high
        if found["n"] > 1 and found["size"] > target * (GROUP if one_text else TOLERANCE):
            if self.low < self.high:
                return False
            if len(self.fixed) < len(_TIES):
                self.fixed, self.low, self.high = (*self.fixed, self.low), 0, _TOP
                return False
        nearer_end = self.before + found["size"] - self.goal < self.goal - self.before
        self.node.cut = (*self.fixed, self.high + 1 if nearer_end else self.low)
        return True


_SEARCHES = "_node int, widest int, n_fixed int, fixed0 long, fixed1 long, first_key long, last_key long, width long"
_CUTS = "_node int, widest int, cut0 long, cut1 long, cut2 long, right_node int"


def _met(rows: DataFrame, table: list[tuple], schema: str, names: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with what a table says of their node, and ``_value``, their value of its widest dimension.

    The table has a row per node, fewer than there are shards, and is sent to all tasks.
    """
    nodes = rows.sparkSession.createDataFrame(table, schema)
    return rows.join(F.broadcast(nodes), "_node", how).withColumn("_value", F.get(F.array(*names), F.col("widest")))


def with_keys(docs: DataFrame, dimensions: Mapping[str, Column]) -> DataFrame:
    """``docs`` with ``_size`` and the columns that the tree looks at."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = lambda c: F.least(F.greatest(F.coalesce(c.cast("long"), F.lit(0)), F.lit(0)), F.lit(_TOP))
    return docs.withColumns(
        {f"_d{i}": key(c) for i, c in enumerate(dimensions.values())}
        | {
            "_size": (F.octet_length(text) + SIZE_EXTRA).cast("long"),
            "_text": F.shiftrightunsigned(F.xxhash64(text), 2),
            "_row": F.shiftrightunsigned(F.xxhash64(id_or_last(), F.lit(1)), 2),
        }
    )


def group_keys(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """Copies of a text get the smallest values found among them, so that they lie at one point."""
    same = rows.groupBy("_text").agg(F.count(F.lit(1)).alias("_n"), *[F.min(d).alias(f"_min{d}") for d in dimensions])
    groups = written(same.filter("_n > 1").drop("_n"), "shard-groups")
    joined = rows.join(groups, "_text", "left")
    return joined.withColumns({d: F.coalesce(f"_min{d}", d) for d in dimensions}).drop(*[f"_min{d}" for d in dimensions])


def cut_once(rows: DataFrame, nodes: dict[int, Node], names: list[str], target: float) -> None:
    """Set the cuts of the ``nodes``; rows carry ``_node``."""
    table = [(first, 0, 0, 0, 0, 0, 0, 0) for first in nodes]
    open_rows = _met(rows, table, _SEARCHES, names)
    points = [F.percentile_approx(d, F.array(F.lit(0.125), F.lit(0.875)), F.lit(1000)).alias(d) for d in names]
    ends = [f(d).alias(f"{f.__name__}{d}") for d in names for f in (F.min, F.max)]
    searches = {}
    for r in open_rows.groupBy("_node").agg(F.sum("_size").alias("size"), *points, *ends).collect():
        reach = {d: (r[d][1] - r[d][0], r[f"max{d}"] - r[f"min{d}"]) for d in names}
        node, widest = nodes[r["_node"]], max(names, key=reach.__getitem__)
        node.widest = names.index(widest)
        goal = r["size"] * (node.shards // 2) / node.shards
        searches[node.first] = _Search(node, goal, r[f"min{widest}"], r[f"max{widest}"])
    key = F.when(F.col("n_fixed") == 0, F.col("_value"))
    for i, tie in enumerate(_TIES, start=1):
        key = key.when(F.col("n_fixed") == i, F.col(tie))
    inside = ((F.col("n_fixed") < 1) | (F.col("_value") == F.col("fixed0"))) & ((F.col("n_fixed") < 2) | (F.col("_text") == F.col("fixed1")))
    while searches:
        # What comes back is bounded, however many nodes there are.
        bins = max(2, min(BINS, MOST_RANGES // len(searches)))
        ranges = _met(rows, [s.row(bins) for s in searches.values()], _SEARCHES, names).withColumn("_key", key)
        ranges = ranges.filter(inside & F.col("_key").between(F.col("first_key"), F.col("last_key")))
        sums = ranges.groupBy("_node", F.expr("CAST((_key - first_key) div width AS int)").alias("_bin")).agg(
            F.sum("_size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("_key").alias("low"), F.max("_key").alias("high")
        )
        histograms: dict[int, dict[int, Row]] = {first: {} for first in searches}
        for r in sums.collect():
            histograms[r["_node"]][r["_bin"]] = r
        searches = {k: s for k, s in searches.items() if not s.narrow(histograms[k], target)}


def split_up(rows: DataFrame, dimensions: list[str], shards: int) -> DataFrame:
    """``rows`` with ``_node``, the number of their shard; written after each level, in place of the level before."""
    spark = rows.sparkSession
    rows = rows.withColumn("_node", F.lit(0))
    total = rows.agg(F.sum("_size")).first()[0] or 0
    leaves, level = [Node(0, shards)], None
    columns = rows.columns
    while todo := {n.first: n for n in leaves if n.shards > 1}:
        cut_once(rows, todo, dimensions, total / shards)
        # A node without rows has no cut.  What a cut leaves open is less than any key.
        cuts = [(n.first, n.widest, *(*n.cut, 0, 0)[:3], n.first + n.shards // 2) for n in todo.values() if n.cut]
        placed = _met(rows, cuts, _CUTS, dimensions, "left")
        below = F.struct("_value", *_TIES) < F.struct("cut0", "cut1", "cut2")
        place = F.when(F.col("cut0").isNull() | below, F.col("_node")).otherwise(F.col("right_node"))
        before, level = level, new_folder(spark, "shard-level")
        placed.withColumn("_node", place).select(columns).write.option("compression", "zstd").parquet(level)
        note_written(level)
        rows = spark.read.schema(rows.schema).parquet(level)
        if before:
            remove_folder(spark, before)
        leaves = [n for n in leaves if n.shards == 1] + [
            Node(first, size)
            for n in todo.values()
            for first, size in ((n.first, n.shards // 2), (n.first + n.shards // 2, n.shards - n.shards // 2))
        ]
    return rows


def with_slots(rows: DataFrame, shards: int, count: int) -> DataFrame:
    """``slot`` counts the rows of a ``shard`` from 0 without gaps."""
    blocks = max(1, -(-count // (shards * BLOCK_ROWS)))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_row", "_text", F.lit(2)), F.lit(blocks)).cast("int"))
    sizes = rows.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("n"))
    line = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_block", F.coalesce(F.sum("n").over(line), F.lit(0)).alias("_start"))
    starts = written(starts, "shard-blocks")
    inside = Window.partitionBy("shard", "_block").orderBy("_row", "_text")
    numbered = rows.withColumn("_place", F.row_number().over(inside) - 1)
    return numbered.join(starts, ["shard", "_block"]).withColumn("slot", F.col("_start") + F.col("_place"))


def shard_documents(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: Mapping[str, Column] | None = None,
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot; ``target_bytes`` a shard if their number isn't given."""
    dimensions = default_dimensions() if dimensions is None else dimensions
    crc = F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")))
    keyed = with_keys(docs, dimensions).withColumn("text_crc32", crc.cast("long"))
    names = [f"_d{i}" for i in range(len(dimensions))]
    rows = keyed.select("doc_id", "text_crc32", "_size", "_text", "_row", *names)
    rows = written(group_keys(written(rows, "shard-keys"), names), "shard-points")
    count, total = rows.agg(F.count(F.lit(1)), F.sum("_size")).first()
    if shards is None:
        shards = max(1, -(-(total or 0) // (target_bytes or 1 << 28)))
    placed = split_up(rows, names, shards).withColumnRenamed("_node", "shard")
    out = with_slots(placed, shards, count)
    return out.select("doc_id", F.col("_size").alias("size"), "text_crc32", "shard", "slot")
