"""Connected components of rows that share values, in rounds that leave about half of a chain's nodes each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedflow.session import cut_lineage


def connected(edges: DataFrame, node: str, link: str, name: str = "component") -> DataFrame:
    """``node`` and the least node that can be reached from it, for the nodes of ``edges`` (node, link).

    Nodes are whole numbers; those with the same ``link`` are neighbours, NULLs link nothing.  A link of any number of
    nodes becomes pairs with its least one.  In each round all nodes get new numbers, a one-to-one hash, and each goes
    over into the least number among its own and its neighbours'; pairs inside of one such node go.  What is left of a
    round is a part of what it began with, so all rounds together read little more than the first, whatever the order
    of the nodes along a chain.
    """
    edges = cut_lineage(edges.select(F.col(node).cast("long").alias("_node"), F.col(link).alias("_link")), "component-edges")
    linked = edges.filter("_link IS NOT NULL")
    hubs = cut_lineage(linked.groupBy("_link").agg(F.min("_node").alias("_b")), "component-hubs")
    pairs = linked.join(hubs, "_link").filter("_node != _b").select(F.col("_node").alias("_a"), "_b")
    pairs = cut_lineage(pairs, "component-pairs")
    rounds = []
    while not pairs.isEmpty():
        moves = _moves(pairs, len(rounds))
        rounds.append(moves)
        for end in ("_a", "_b"):
            pairs = pairs.join(moves.select(F.col("_node").alias(end), F.col("_to").alias(f"_to{end}")), end)
        pairs = pairs.filter("_to_a != _to_b").select(F.least("_to_a", "_to_b").alias("_a"), F.greatest("_to_a", "_to_b").alias("_b"))
        pairs = cut_lineage(pairs.distinct(), "component-pairs")
    nodes = edges.select("_node").distinct()
    if not rounds:
        return nodes.select(F.col("_node").alias(node), F.col("_node").alias(name))
    least = _least(rounds)
    return nodes.join(least, "_node", "left").select(F.col("_node").alias(node), F.coalesce("_least", "_node").alias(name))


def _moves(pairs: DataFrame, number: int) -> DataFrame:
    """What each node of ``pairs`` goes over into, in a round."""

    def anew(end: str) -> Column:
        return F.xxhash64(end, F.lit(number))

    least = F.least(anew("_a"), anew("_b")).alias("_to")
    ends = [F.struct(F.col(end).alias("_node"), least) for end in ("_a", "_b")]
    moves = pairs.select(F.inline(F.array(*ends))).groupBy("_node").agg(F.min("_to").alias("_to"))
    return cut_lineage(moves, "component-moves")


def _least(rounds: list[DataFrame]) -> DataFrame:
    """The least node of its component for each node that was in a pair at first."""
    # Numbers of different rounds may be equal by chance, so the round in which a component was complete goes with it.
    ends = None
    for number, moves in reversed(list(enumerate(rounds))):
        moves = moves.withColumn("_round", F.lit(number))
        if ends is not None:
            later = ends.select(F.col("_node").alias("_to"), F.col("_to").alias("_later"), F.col("_round").alias("_last"))
            moves = moves.join(later, "_to", "left").select(
                "_node", F.coalesce("_later", "_to").alias("_to"), F.coalesce("_last", "_round").alias("_round")
            )
        ends = moves
    ends = cut_lineage(ends, "component-ends")
    least = cut_lineage(ends.groupBy("_to", "_round").agg(F.min("_node").alias("_least")), "component-least")
    return ends.join(least, ["_to", "_round"]).select("_node", "_least")
