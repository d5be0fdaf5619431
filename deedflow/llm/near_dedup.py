"""Near-duplicate groups by SuperMinHash signatures, bands, exact verification and union-find.

A document's set are the hashes of its distinct 4-word shingles.  Documents with one set are one
node from the start.  SuperMinHash gives every element a random permutation of the slots, built step
by step, and a rank that grows with the step; a signature is done as soon as every slot is taken,
since later steps cannot lower a slot.  ``BANDS`` bands of ``ROWS`` slots are bucket keys: a pair of
similarity 0.8 shares none with a chance of (1 - 0.8^4)^32 = 5e-8.

No bucket is turned into all its pairs:

1. Each node is compared with one pivot, the smallest document of the bucket it shares most bands
   with.  Links are confirmed on the full sets, and union-find joins them to components.
2. Nodes of buckets that hold several components yet are joined over the rarest of their shingles
   (prefix and position filters, which lose no pair of the similarity asked for), and only pairs of
   different components are compared.  Of the components at a shingle, the fullest is never paired
   with itself.

Defined results: A-Z are lowered; a text of 1 to 3 words is one shingle; without words a document
is its own component, linked with nothing; a null id counts as larger than every other, and a
component of such rows only has a null component_id; ``kept`` holds for the row with the component's
smallest id, among equal ids for the one with the smallest text hash, and for all rows equal in both,
of which :func:`keep_one` keeps one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedflow.llm.rows import NO_ID, distilled, id_or_last, written
from deedflow.llm.text import Words, mixed, pieces, windows, word_hashes, words_of

WIDTH = 4
BANDS, ROWS = 32, 4
SLOTS = BANDS * ROWS
# Linked if 100 * intersection >= PERCENT * union.
PERCENT = 80
_MAX = np.uint64(2**64 - 1)


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text with their rows, in order of rows."""
    hashes, rows, counts = word_hashes(words), words.rows, words.counts
    found, at = windows(hashes, rows, WIDTH)
    parts, owners = [found], [rows[at]]
    for n in range(1, WIDTH):
        short, at = windows(hashes, rows, n)
        whole = counts[rows[at]] == n
        parts.append(short[whole])
        owners.append(rows[at[whole]])
    found, owners = np.concatenate(parts), np.concatenate(owners)
    _, first = np.unique(mixed(found + owners.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    first = first[np.argsort(owners[first], kind="stable")]
    return found[first], owners[first]


def super_min_hash(elements: np.ndarray, rows: np.ndarray, n: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures (n, slots) of n sets; ``rows`` says to which set each element belongs, in order.

    A slot holds the least of step * 2^32 + 32 random bits over the elements that reach it.
    """
    out = np.full(n * slots, _MAX, np.uint64)
    order = None
    for step in range(slots):
        random = mixed(elements + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % 2**64))
        rank = np.uint64(step << 32) | (random >> np.uint64(32))
        target = step + (((random & np.uint64(0xFFFFFFFF)) * np.uint64(slots - step)) >> np.uint64(32)).astype(np.int64)
        if step == 0:
            slot, first = target, target
        else:
            if order is None:
                # Only sets that step 0 left open come here; their first exchange is made up for.
                order = np.tile(np.arange(slots, dtype=np.uint8), (len(elements), 1))
                every = np.arange(len(elements))
                order[every, 0], order[every, first] = first, 0
            slot = order[every, target].astype(np.int64)
            order[every, target] = order[:, step]
            order[:, step] = slot
        np.minimum.at(out, rows * slots + slot, rank)
        open_rows = (out.reshape(n, slots) == _MAX).any(axis=1)
        left = open_rows[rows]
        if not left.any():
            break
        if not left.all():
            elements, rows = elements[left], rows[left]
            if order is None:
                first = first[left]
            else:
                order, every = order[left], np.arange(len(elements))
    return out.reshape(n, slots)


def _sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    at = np.searchsorted(rows, np.arange(n + 1))
    return total[at[1:]] - total[at[:-1]]


def _fingerprints(column: pa.Array) -> dict[str, pa.Array]:
    """Of each text: a 128-bit digest of its set, the set's size, and its bucket keys."""
    words = words_of(column, lower=True)
    n = len(words.counts)
    elements, rows = shingles(words)
    sizes = np.bincount(rows, minlength=n)
    digest = np.stack([_sums(mixed(elements + np.uint64(c)), rows, n) for c in (0x1234567, 0x89ABCDEF01)], axis=1)
    signatures = super_min_hash(elements, rows, n).reshape(n, BANDS, ROWS)
    keys = np.zeros((n, BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        keys *= np.uint64(0xD6E8FEB86659FD93)
        keys += mixed(signatures[:, :, i].copy())
    empty = sizes == 0
    offsets = np.concatenate([[0], np.cumsum(np.where(empty, 0, BANDS))]).astype(np.int32)
    values = pa.array(mixed(keys[~empty].reshape(-1)).view(np.int64))
    raw = digest.astype("<u8").tobytes()
    node = pa.array([None if e else raw[16 * i : 16 * i + 16] for i, e in enumerate(empty)], pa.binary())
    return {"node": node, "n": pa.array(sizes.astype(np.int64)), "keys": pa.ListArray.from_arrays(pa.array(offsets), values)}


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(id_or_last().alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("row"), text.alias("text"))


def signatures(docs: DataFrame) -> DataFrame:
    """id, row (hash of the text), node (digest of the set, null if empty), n and bucket keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            found = _fingerprints(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), *found.values()], ["id", "row", *found]
            )

    return _texts(docs).mapInArrow(run, "id long, row long, node binary, n long, keys array<long>")


def _shared(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the sets of two text columns, and of their intersections, row by row."""
    sides = [shingles(words_of(c, lower=True)) for c in (a, b)]
    keys = [mixed(e + r.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for e, r in sides]
    both = np.isin(keys[0], keys[1], assume_unique=True)
    n = len(a)
    size_a, size_b = (np.bincount(r, minlength=n) for _, r in sides)
    return size_a, size_b, np.bincount(sides[0][1][both], minlength=n)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of nodes whose full sets are similar enough; ``texts`` has node and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (q for b in batches for p in pieces(b, "text_a") for q in pieces(p, "text_b")):
            size_a, size_b, common = _shared(batch.column("text_a"), batch.column("text_b"))
            linked = 100 * common >= PERCENT * (size_a + size_b - common)
            yield batch.select(["a", "b"]).filter(pa.array(linked))

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    # Merge joins at any size: texts are shuffled by their keys, never sent along as a whole.
    pairs = pairs.select("a", "b").hint("merge").join(one, "a").hint("merge").join(two, "b")
    return pairs.mapInArrow(run, "a binary, b binary")


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one task; (node, root) of every node that is not its root."""
    parent: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    made = [(x, root(x)) for x in list(parent)]
    made = [(x, r) for x, r in made if x != r]
    yield pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in made], pa.binary()), pa.array([r for _, r in made], pa.binary())], ["a", "b"]
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) for all linked nodes but the roots, which are the least of their component.

    Every task joins its links by union-find; between tasks, stars are joined by turns: every node
    hands its larger neighbours to its least one, then all its smaller ones.  Links of a hot node are
    stored rows on both sides of a join, which Spark can split.
    """
    edges = written(links.mapInArrow(_local_forest, "a binary, b binary"), "forest")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "stars")
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.filter("a <> b").distinct(), "large-star")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "stars")
        handed = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(handed.unionByName(least.withColumnRenamed("m", "b")).distinct(), "small-star")


def _prefix_tokens(texts: DataFrame) -> DataFrame:
    """Rarest shingles of each node: (token, node, n, place), as many as a similar set must meet one of.

    Shingles are ordered by the number of nodes that have them, then by hash.  Those of one node only
    come first; they meet nothing and are counted, not kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            elements, rows = shingles(words_of(batch.column("text"), lower=True))
            sizes = np.bincount(rows, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(elements.view(np.int64)), batch.column("node").take(pa.array(rows)), pa.array(sizes[rows])],
                ["token", "node", "n"],
            )

    tokens = texts.select("node", "text").mapInArrow(run, "token long, node binary, n long")
    often = written(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "token-counts")
    lists = tokens.join(often, "token").groupBy("node").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "token"))).alias("list")
    )
    most = F.expr(f"CAST(n - (n * {PERCENT} + 99) div 100 + 1 AS int)")
    lists = lists.withColumn("alone", (F.col("n") - F.size("list")).cast("int")).withColumn("left", most - F.col("alone"))
    rows = lists.filter("left > 0").select("node", "n", "alone", F.posexplode(F.expr("slice(list, 1, left)")).alias("i", "t"))
    return rows.select(F.col("t.token").alias("token"), "node", "n", (F.col("alone") + F.col("i")).alias("place"))


def _open_pairs(texts: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of nodes of different components that may be similar, over their rare shingles."""
    tokens = written(_prefix_tokens(texts).join(roots, "node"), "prefixes")
    sums = tokens.groupBy("token", "root").agg(F.count(F.lit(1)).alias("c"))
    mixed_ones = sums.groupBy("token").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
    mixed_ones = written(mixed_ones.filter("roots > 1").drop("roots"), "mixed-tokens")
    rows = written(tokens.join(mixed_ones, "token"), "mixed-prefixes")
    x = rows.filter("root <> main").select("token", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "place", "root")])
    y = rows.select("token", "main", *[F.col(c).alias(f"y_{c}") for c in ("node", "n", "place", "root")])
    # Similar sets share at least PERCENT / (100 + PERCENT) of the sum of their sizes; what stands
    # after the common shingle in either order must suffice for that.
    room = F.least(F.col("x_n") - F.col("x_place"), F.col("y_n") - F.col("y_place"))
    near = (100 + PERCENT) * room >= PERCENT * (F.col("x_n") + F.col("y_n"))
    sides = (F.col("y_root") == F.col("main")) | (F.col("x_node") < F.col("y_node"))
    pairs = x.join(y, (x["token"] == y["token"]) & (F.col("x_root") != F.col("y_root")) & sides & near)
    return pairs.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def grouped(docs: DataFrame) -> DataFrame:
    """id, row, n, and the first (id, row) of the component, of every row of ``docs``."""
    rows = written(signatures(docs), "signatures")
    place = F.struct("id", "row")
    nodes = rows.filter("node IS NOT NULL").groupBy("node").agg(F.min(place).alias("first"), F.first("keys").alias("keys"))
    nodes = written(nodes.select("node", F.col("first.id").alias("id"), F.col("first.row").alias("row"), "keys"), "nodes")
    spark = docs.sparkSession
    links = distilled(spark, "links", lambda: _links(docs, nodes))
    roots = distilled(spark, "roots", lambda: components(links))
    # A root has no row in ``roots``; a node that is in no link is its own root.
    rooted = nodes.select("node", place.alias("own")).join(roots, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    firsts = written(rooted.groupBy("root").agg(F.min("own").alias("component")), "labels")
    label = written(rooted.select("node", "root").join(firsts, "root").select("node", "component"), "components")
    out = rows.select("id", "row", "node", "n").join(label, "node", "left")
    return out.select("id", "row", "n", F.coalesce("component", place).alias("component"))


def _own_id(column: Column) -> Column:
    return F.when(column != NO_ID, column)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    return grouped(docs).select(
        _own_id(F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"),
        _own_id(F.col("component.id")).alias("component_id"), (F.struct("id", "row") == F.col("component")).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component, with all its columns."""
    kept = grouped(docs).filter(F.struct("id", "row") == F.col("component")).select("id", "row").distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumns({"_near_id": id_or_last(), "_near_row": F.xxhash64(text)})
    kept = written(kept.select(F.col("id").alias("_near_id"), F.col("row").alias("_near_row")), "kept")
    return keyed.join(kept.hint("merge"), ["_near_id", "_near_row"]).dropDuplicates(["_near_id", "_near_row"]).select(docs.columns)


def _links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    bands = nodes.select("node", "id", F.explode("keys").alias("key"))
    pivots = bands.groupBy("key").agg(F.min(F.struct("id", "node")).alias("pivot"), F.count(F.lit(1)).alias("n"))
    pivots = written(pivots.filter("n > 1").select("key", "pivot"), "pivots")
    members = written(bands.select("key", "node").join(pivots, "key"), "members")
    inside = written(members.select("node").distinct().join(nodes.drop("keys"), "node"), "inside")
    texts = _texts(docs).join(inside.hint("merge"), ["id", "row"]).select("node", "text").dropDuplicates(["node"])
    texts = written(texts, "texts")
    votes = members.filter("node <> pivot.node").groupBy("node", "pivot").agg(F.count(F.lit(1)).alias("c"))
    best = votes.groupBy("node").agg(F.max_by("pivot", F.struct("c", F.negative("pivot.id"))).alias("pivot"))
    stars = best.select(F.col("node").alias("a"), F.col("pivot.node").alias("b"))
    links = written(confirmed(stars, texts), "star-links")
    roots = distilled(docs.sparkSession, "star-roots", lambda: components(links))
    placed = inside.select("node").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    placed = written(placed, "placed")
    held = members.select("key", "node").join(placed, "node")
    several = held.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("key")
    several = written(several, "open-keys")
    open_nodes = written(members.select("key", "node").join(several, "key").select("node").distinct(), "open-nodes")
    open_texts = written(texts.join(open_nodes, "node"), "open-texts")
    more = distilled(docs.sparkSession, "more-links", lambda: confirmed(_open_pairs(open_texts, placed), texts))
    return links.unionByName(more)

