"""Which rows of a batch are stored, where rows compete for keys or block one another.

The batch is meant to arrive row by row: a row is stored unless an earlier stored row has one of its
keys or blocks it in its group.  Only rows that share a repeated key, and the groups they are in, take
part.  Those that may influence one another, the components of shared keys and groups, are settled in
the order of their numbers in one task if they are ``SETTLED_ROWS`` at most.  A larger component goes in
rounds: a row before which nothing that could stop it is undecided is stored, what it stops is dropped, and
the rest goes on; where rounds decide little, the next ``SETTLED_ROWS`` rows are settled in order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deedflow.operators.components import connected
from deedflow.session import cut_lineage

# How a row stands to others of its group: ALONE bars all later rows and comes after no SHARED or
# ALONE one; SHARED bars later ALONE ones; MUTE bars none.  SHARED and MUTE come after no ALONE one.
ALONE, SHARED, MUTE = "alone", "shared", "mute"

# So many rows, of keys and numbers only, are settled in one task.
SETTLED_ROWS = 200_000
# A round that leaves more than this part undecided is followed by rows in order.
SLOW = 7 / 8


def _joined(rows: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State is written first: a stored table on either side lets Spark split a hot key."""
    return rows.join(cut_lineage(state, "conflict-state"), list(keys), "left")


def _is(kind: str) -> Column:
    return F.col("_kind") == kind


def settle(rows: DataFrame, keys: Sequence[str], group: Sequence[str] = (), most: int = SETTLED_ROWS) -> DataFrame:
    """``seq`` of the stored rows.  With a group, ``_kind`` says how rows stand to each other in it."""
    return decided(rows, keys, group, most).filter("_stored").select("seq")


def decided(rows: DataFrame, keys: Sequence[str], group: Sequence[str] = (), most: int = SETTLED_ROWS) -> DataFrame:
    """``seq`` and keys of all rows, and whether they are ``_stored``; see :func:`settle`."""
    columns = ["seq", *keys, *group, *(["_kind"] if group else [])]
    left = cut_lineage(rows.select(*columns), "conflict-rows")
    if left.count() <= most:
        return _in_order(left.withColumn("_component", F.lit(0).cast("long")).coalesce(1), keys, group)
    # A row links its first key to its others, so a key's rows are one node.  Equal hashes of different keys only bring
    # two components together.
    links = [_link(key, F.col(key).isNotNull(), F.col(key).cast("string")) for key in keys]
    if group:
        parts = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in group]))
        links.append(_link("", reduce(Column.__and__, [F.col(c).isNotNull() for c in group]), parts))
    placed = left.withColumn("_component", F.coalesce(*links, F.xxhash64(F.lit("seq"), "seq")))
    if len(links) > 1:
        edges = placed.select(F.col("_component").alias("_node"), F.explode(F.array(*links[1:])).alias("_link"))
        components = cut_lineage(connected(edges, "_node", "_link", "_whole"), "conflict-components")
        placed = placed.withColumnRenamed("_component", "_node").join(components, "_node").withColumnRenamed("_whole", "_component")
        placed = cut_lineage(placed.select(*columns, "_component"), "conflict-placed")
    large = placed.groupBy("_component").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > most)
    large = cut_lineage(large.select("_component"), "conflict-large")
    if large.isEmpty():
        return _in_order(placed.repartition("_component"), keys, group)
    small = placed.join(large, "_component", "left_anti").repartition("_component")
    rest = cut_lineage(placed.join(large, "_component", "left_semi").select(*columns), "conflict-rows")
    stored = _by_rounds(rest, keys, group, most).withColumn("_stored", F.lit(True))
    rest = rest.join(stored, "seq", "left").select("seq", *keys, F.coalesce("_stored", F.lit(False)).alias("_stored"))
    return _in_order(small, keys, group).unionAll(cut_lineage(rest, "conflict-stored"))


def _link(of: str, known: Column, value: Column) -> Column:
    return F.when(known, F.xxhash64(F.lit(of), value))


def _in_order(rows: DataFrame, keys: Sequence[str], group: Sequence[str]) -> DataFrame:
    """The rows of whole components with ``_stored``, each component in one task and in the order of its numbers.

    Of a component a task holds the keys and groups of what it stored.
    """
    n_keys, n_group, alone, shared = len(keys), len(group), ALONE, SHARED

    def choose(batches: Iterator) -> Iterator:
        import pyarrow as pa

        component, held, bars = None, [set() for _ in range(n_keys)], {}
        for batch in batches:
            chosen = []
            of_rows, *columns = (batch.column(i).to_pylist() for i in range(batch.num_columns) if i != 1)
            for of, *values in zip(of_rows, *columns):
                if of != component:
                    component, held, bars = of, [set() for _ in range(n_keys)], {}
                stored = True
                for value, seen in zip(values, held):
                    if value in seen:
                        stored = False
                        break
                if stored and n_group:
                    place, kind = tuple(values[n_keys : n_keys + n_group]), values[-1]
                    barred = bars.get(place)
                    if None not in place:
                        if barred == alone or (barred == shared and kind == alone):
                            stored = False
                        elif kind in (alone, shared):
                            bars[place] = kind
                if stored:
                    for value, seen in zip(values, held):
                        if value is not None:
                            seen.add(value)
                chosen.append(stored)
            names = ["seq", *keys, "_stored"]
            yield pa.RecordBatch.from_arrays([*batch.columns[1 : 2 + n_keys], pa.array(chosen, pa.bool_())], names)

    columns = ["_component", "seq", *keys, *group, *(["_kind"] if group else [])]
    ordered = rows.select(*columns).sortWithinPartitions("_component", "seq")
    schema = T.StructType([*[rows.schema[c] for c in ("seq", *keys)], T.StructField("_stored", T.BooleanType())])
    return cut_lineage(ordered.mapInArrow(choose, schema), "conflict-stored")


def _without_barred(left: DataFrame, chosen: DataFrame, keys: Sequence[str], group: Sequence[str]) -> DataFrame:
    """The rows that the ``chosen`` ones do not stop."""
    columns = left.columns
    for key in keys:
        left = left.join(chosen.filter(F.col(key).isNotNull()).select(key).distinct(), key, "left_anti")
    if group:
        taken = chosen.groupBy(*group).agg(
            F.min(F.when(_is(ALONE), F.col("seq"))).alias("_bars_all"),
            F.min(F.when(_is(SHARED), F.col("seq"))).alias("_bars_alone"),
        )
        barred = (F.col("seq") > F.col("_bars_all")) | (_is(ALONE) & (F.col("seq") > F.col("_bars_alone")))
        left = _joined(left, taken, group).filter(~F.coalesce(barred, F.lit(False)))
    return cut_lineage(left.select(*columns), "conflict-rows")


def _round(left: DataFrame, keys: Sequence[str], group: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows before which nothing that could stop them is undecided, and the other rows."""
    ready = F.lit(True)
    marked = left
    for key in keys:
        first = left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min("seq").alias(f"_first_{key}"))
        marked = _joined(marked, first, [key])
        ready &= F.coalesce(F.col("seq") == F.col(f"_first_{key}"), F.lit(True))
    if group:
        mins = left.groupBy(*group).agg(
            F.min(F.when(_is(ALONE), F.col("seq"))).alias("_alone"),
            F.min(F.when(~_is(MUTE), F.col("seq"))).alias("_known"),
        )
        marked = _joined(marked, mins, group)
        before = F.when(_is(ALONE), F.col("_known")).otherwise(F.col("_alone"))
        ready &= F.coalesce(F.col("seq") <= before, F.lit(True))
    marked = cut_lineage(marked.select(*left.columns, ready.alias("_ready")), "conflict-round")
    return marked.filter("_ready").drop("_ready"), marked.filter(~F.col("_ready")).drop("_ready")


def _by_rounds(rows: DataFrame, keys: Sequence[str], group: Sequence[str], most: int) -> DataFrame:
    """``seq`` of the stored rows."""
    left = rows
    stored = []
    undecided = left.count()
    while undecided:
        if undecided > most:
            chosen, others = _round(left, keys, group)
            left = _without_barred(others, chosen, keys, group)
            stored.append(chosen.select("seq"))
            before, undecided = undecided, left.count()
        if undecided and (undecided <= most or undecided > before * SLOW):
            last = left.select("seq").orderBy("seq").limit(most).agg(F.max("seq")).first()[0]
            first = left.filter(F.col("seq") <= last)
            in_order = _in_order(first.withColumn("_component", F.lit(0).cast("long")).repartition(1), keys, group)
            in_order = in_order.filter("_stored").select("seq")
            stored.append(in_order)
            chosen = first.join(in_order, "seq", "left_semi")
            left = _without_barred(left.filter(F.col("seq") > last), chosen, keys, group)
            undecided = left.count()
    return reduce(DataFrame.unionAll, stored)
