"""Mixing sources to target weights over a tree of levels such as domain, language and source.

A token budget goes down the tree.  At each node the children share the node's tokens by weight; a
child that has too little (its tokens times ``max_epochs``) is filled up and what it leaves goes to
its siblings, so a shortage reaches an ancestor's siblings only if a whole subtree is short.  Each
leaf then reads its documents in seeded orders, one order per epoch, and takes the prefix that holds
its tokens: whole epochs, and of the last one whole documents and the first tokens of one more.

The shares are window sums over the few children of a node.  A leaf's prefix is found from the token
sums of at most ``BINS`` ranges of its order; only the documents of the one range in which the prefix
ends are put in order, so a leaf with a third of all rows is never one task.

Defined results: a null level value counts as ''; a child of weight 0 gets nothing; a leaf without
tokens takes no document; documents without tokens come along where the prefix passes them; repeated
rows are documents of their own; a null id is ordered like the text 'null'.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deedflow.llm.rows import written

WORD = r"[^\x20\x09-\x0D]+"
ORDER_BITS = 60
BIN_BITS = 12
BINS = 1 << BIN_BITS

Weights = Mapping[str, Mapping[str, int]]


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def order_key(seed: int, epoch: Column) -> Column:
    """Place of a document in the order of an epoch, 60 bits of an md5."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, ORDER_BITS // 4), 16, 10).cast("long")


def _weight(level: str, weights: Weights) -> Column:
    out = F.lit(1)
    for value, weight in weights.get(level, {}).items():
        out = F.when(F.col(level) == value, weight).otherwise(out)
    return out.cast("decimal(38,0)")


def _shared_out(children: DataFrame, parents: Sequence[str], name: str) -> DataFrame:
    """``given`` of each child from the node's ``budget``; children have ``room`` and ``weight``.

    Sorted by room per weight, children are filled up from the first on until one has room for its
    share of what is left; it and all after it share the rest, the odd tokens going to the first.
    """
    node = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    ratio = F.when(F.col("weight") > 0, F.col("room").cast("double") / F.col("weight").cast("double"))
    line = node.orderBy(F.col("ratio").asc_nulls_last(), name)
    before = F.coalesce(F.sum("room").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(line.rowsBetween(0, Window.unboundedFollowing))
    full = F.expr("weight > 0 AND room * left_weight <= weight * (budget - before)")
    rest = F.expr("CASE WHEN weight > 0 THEN (weight * spare) div open_weight ELSE 0 END")
    odd = F.expr("weight > 0 AND place <= spare - taken")
    return (
        children.withColumn("ratio", ratio)
        .withColumns({"before": before, "left_weight": left})
        .withColumn("full", full)
        .withColumns({
            "spare": F.col("budget") - F.sum(F.when(F.col("full"), F.col("room")).otherwise(0)).over(node),
            "open_weight": F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(node),
        })
        .withColumn("part", F.when(F.col("full"), 0).otherwise(rest))
        .withColumns({
            "taken": F.sum("part").over(node),
            "place": F.row_number().over(node.orderBy("full", F.col("ratio").asc_nulls_last(), name)),
        })
        .withColumn("given", F.when(F.col("full"), F.col("room")).otherwise(F.col("part") + F.when(odd, 1).otherwise(0)))
        .withColumn("given", F.col("given").cast("decimal(20,0)"))
    )


def leaf_budgets(
    docs: DataFrame, levels: Sequence[str], weights: Weights, share: tuple[int, int], max_epochs: int
) -> DataFrame:
    """One row per leaf with its ``tokens`` and the tokens ``given``; ``share`` is a part of all tokens."""
    wide, levels = "decimal(20,0)", list(levels)
    leaves = docs.groupBy(*levels).agg(F.sum("n_tokens").cast(wide).alias("tokens"))
    leaves = written(leaves, "leaves").withColumn("room", (F.col("tokens") * max_epochs).cast(wide))
    rooms = {}
    for depth in range(len(levels), 0, -1):
        if depth < len(levels):
            leaves_up = rooms[depth + 1].groupBy(*levels[:depth]).agg(F.sum("room").cast(wide).alias("room"))
        else:
            leaves_up = leaves
        weight = _weight(levels[depth - 1], weights)
        usable = F.when(F.col("weight") > 0, F.col("room")).otherwise(0).cast(wide)
        rooms[depth] = leaves_up.withColumn("weight", weight).withColumn("room", usable)
    room = int(rooms[1].agg(F.sum("room")).first()[0] or 0)
    total = int(leaves.agg(F.sum("tokens")).first()[0] or 0)
    budget = min(total * share[0] // share[1], room)
    given = rooms[1].withColumn("budget", F.lit(budget).cast(wide))
    for depth in range(1, len(levels) + 1):
        path = levels[:depth]
        if depth > 1:
            above = given.select(*levels[: depth - 1], F.col("given").alias("budget"))
            given = rooms[depth].join(above, levels[: depth - 1])
        kept = [*path, "given", "tokens"] if depth == len(levels) else [*path, "given"]
        given = _shared_out(given, levels[: depth - 1], levels[depth - 1]).select(*kept)
    return given.select(*levels, F.col("tokens").cast("long").alias("tokens"), F.col("given").cast("long").alias("given"))


def mix(
    docs: DataFrame,
    levels: Sequence[str],
    weights: Weights,
    share: tuple[int, int] = (8, 10),
    max_epochs: int = 2,
    seed: int = 0,
) -> DataFrame:
    """The chosen rows of ``docs``, which needs ``doc_id``, ``n_tokens`` and the levels.

    Added are ``epoch`` (from 0) and ``taken_tokens``, which is less than ``n_tokens`` for the one
    document at which a leaf's last epoch ends.
    """
    levels = list(levels)
    docs = docs.withColumns({level: F.coalesce(F.col(level).cast("string"), F.lit("")) for level in levels})
    plan = leaf_budgets(docs, levels, weights, share, max_epochs).filter("given > 0")
    plan = plan.selectExpr(*levels, "given div tokens AS mix_full", "given % tokens AS mix_rest")
    plan = written(plan, "leaf-plan")
    placed = (
        docs.join(plan, levels)
        .withColumn("mix_order", order_key(seed, F.col("mix_full")))
        .withColumn("mix_bin", F.shiftright("mix_order", ORDER_BITS - BIN_BITS))
    )
    bins = placed.filter("mix_rest > 0").groupBy(*levels, "mix_bin").agg(
        F.max("mix_rest").alias("rest"), F.sum("n_tokens").alias("tokens")
    )
    line = Window.partitionBy(*levels).orderBy("mix_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = (
        bins.withColumn("upto", F.sum("tokens").over(line))
        .filter("upto - tokens < rest AND rest <= upto")
        .select(*levels, F.col("mix_bin").alias("mix_cut"), (F.col("upto") - F.col("tokens")).alias("mix_before"))
    )
    ends = written(ends, "leaf-ends")
    placed = placed.join(ends, levels, "left")
    last = F.expr("CASE WHEN mix_bin < mix_cut THEN mix_full ELSE mix_full - 1 END")
    whole = (
        placed.withColumn("mix_last", last)
        .filter("mix_last >= 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), "mix_last")))
        .withColumn("taken_tokens", F.col("n_tokens"))
    )
    order = Window.partitionBy(*levels).orderBy("mix_order", "doc_id", "n_tokens")
    past = F.coalesce(F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = (
        placed.filter("mix_bin = mix_cut")
        .withColumn("mix_left", F.col("mix_rest") - F.col("mix_before") - past)
        .filter("mix_left > 0")
        .withColumn("epoch", F.col("mix_full"))
        .withColumn("taken_tokens", F.least("n_tokens", "mix_left"))
    )
    kept = [*docs.columns, "epoch", "taken_tokens"]
    return whole.select(kept).unionByName(edge.select(kept))


def first_words(text: str, count: str) -> Column:
    """The first words of a text up to ``count``, with what stands between them."""
    pattern = F.concat(F.lit(r"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){"), F.col(count).cast("string"), F.lit("}+"))
    return F.coalesce(F.regexp_substr(F.col(text), pattern), F.lit(""))
