"""Quality rules: boosted trees over document statistics, scored as flat node arrays.

The trees are grown in numpy on a bounded sample of labelled rows (``TRAIN_ROWS``, those with the
smallest hash of their id).  A feature with a sign in ``stats.FEATURES`` may only lower the score as
it grows: a split that would break this is not taken, and the children's values are bounded by the
middle between them.  Scoring walks all texts of a batch down a tree at once.

Defined results: a null text has no words and fails the base rules, as every text of fewer than 10
words does; a null id is carried; repeated rows are judged alike; without labels of both kinds
there is no model and the base rules decide alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deedflow.llm.stats import BASE, FEATURES, statistics
from deedflow.llm.text import pieces

TRAIN_ROWS = 20_000
LEAST_WORDS = 10
MOST_REPEATED = 20
TREES, DEPTH, RATE, BINS, LEAST_HESSIAN, RIDGE = 40, 3, 0.2, 32, 4.0, 1.0
# A document is rejected if the trees give it less than this chance of being good.
THRESHOLD = 0.5


@dataclass
class Forest:
    """Nodes of all trees; a leaf points to itself.  ``roots`` are the trees' first nodes."""

    feature: list[int] = field(default_factory=list)
    bound: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    roots: list[int] = field(default_factory=list)
    start: float = 0.0

    def add(self, value: float) -> int:
        node = len(self.value)
        for column, x in zip((self.feature, self.bound, self.left, self.right, self.value), (0, 0.0, node, node, value), strict=True):
            column.append(x)
        return node

    def margins(self, x: np.ndarray) -> np.ndarray:
        feature, left, right = (np.array(c, np.int64) for c in (self.feature, self.left, self.right))
        bound, value = np.array(self.bound), np.array(self.value)
        total, every = np.full(len(x), self.start), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                node = np.where(x[every, feature[node]] <= bound[node], left[node], right[node])
            total += value[node]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(x)))


def _leaf(g: float, h: float, low: float, high: float) -> float:
    return min(max(-g / (h + RIDGE), low), high)


def _gain(value: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return -(g * value + (h + RIDGE) * value * value / 2)


def _grow(
    forest: Forest, bins: np.ndarray, cuts: list[np.ndarray], signs: list[int], g: np.ndarray, h: np.ndarray,
    rows: np.ndarray, depth: int, low: float, high: float,
) -> int:
    node = forest.add(RATE * _leaf(g[rows].sum(), h[rows].sum(), low, high))
    if depth == 0 or len(rows) < 2:
        return node
    all_g, all_h = g[rows].sum(), h[rows].sum()
    here = _gain(np.array(_leaf(all_g, all_h, low, high)), all_g, all_h)
    best = (1e-6, -1, -1, 0.0, 0.0)
    for f, sign in enumerate(signs):
        if not len(cuts[f]):
            continue
        left_g = np.cumsum(np.bincount(bins[rows, f], g[rows], len(cuts[f]) + 1))[:-1]
        left_h = np.cumsum(np.bincount(bins[rows, f], h[rows], len(cuts[f]) + 1))[:-1]
        right_g, right_h = all_g - left_g, all_h - left_h
        a = np.clip(-left_g / (left_h + RIDGE), low, high)
        b = np.clip(-right_g / (right_h + RIDGE), low, high)
        gains = _gain(a, left_g, left_h) + _gain(b, right_g, right_h) - here
        gains[(left_h < LEAST_HESSIAN) | (right_h < LEAST_HESSIAN) | (sign * (b - a) < 0)] = -np.inf
        at = int(np.argmax(gains))
        if gains[at] > best[0]:
            best = (gains[at], f, at, a[at], b[at])
    _, f, at, a, b = best
    if f < 0:
        return node
    middle, below = (a + b) / 2, bins[rows, f] <= at
    sides = ((low, middle), (middle, high)) if signs[f] > 0 else ((middle, high), (low, middle)) if signs[f] < 0 else ((low, high),) * 2
    forest.feature[node], forest.bound[node] = f, float(cuts[f][at])
    forest.left[node] = _grow(forest, bins, cuts, signs, g, h, rows[below], depth - 1, *sides[0])
    forest.right[node] = _grow(forest, bins, cuts, signs, g, h, rows[~below], depth - 1, *sides[1])
    return node


def grow_forest(x: np.ndarray, y: np.ndarray, signs: list[int]) -> Forest:
    """Boosted trees for the chance that ``y`` is 1; each step fits the log loss to second order."""
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    bins = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, x.T, strict=True)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    forest = Forest(start=float(np.log(share / (1 - share))))
    margin = np.full(len(y), forest.start)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        root = _grow(forest, bins, cuts, signs, p - y, p * (1 - p), np.arange(len(y)), DEPTH, -np.inf, np.inf)
        forest.roots.append(root)
        tree = Forest(forest.feature, forest.bound, forest.left, forest.right, forest.value, [root])
        margin += tree.margins(x)
    return forest


def in_training(doc_id: str = "doc_id") -> Column:
    """The rows whose labels may be learned from."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 != 0


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, most: int = TRAIN_ROWS) -> DataFrame:
    """Texts and labels of at most ``most`` rows, those whose id has the smallest hash.

    Of rows with one id, the text with the smallest hash and the least label are taken.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("_id"), F.col(column).cast("double").alias("label"))
        .filter(in_training("_id") & F.col("label").isNotNull())
        .groupBy("_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(most)
    )
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # Bounded by ``most`` rows.
    found = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    least = F.min_by(F.struct("text", "label"), F.struct(F.xxhash64("text"), "text"))
    return found.groupBy("doc_id").agg(least.alias("_row")).select("doc_id", "_row.text", "_row.label")


_STATS = T.StructType(
    [T.StructField(c, T.LongType()) for c in BASE] + [T.StructField(c, T.DoubleType()) for c in FEATURES]
)


def with_statistics(docs: DataFrame, carried: T.StructType) -> DataFrame:
    """The columns of ``carried`` with the statistics of ``text``."""
    names = carried.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            found = statistics(batch.column("text"))
            columns = [batch.column(c) for c in names] + [pa.array(v) for v in found.values()]
            yield pa.RecordBatch.from_arrays(columns, [*names, *found])

    source = docs.select(*[c for c in names if c != "text"], F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, T.StructType([*carried.fields, *_STATS.fields]))


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Forest | None:
    sample = labelled_sample(docs, labels, "quality", most)
    rows = with_statistics(sample, T.StructType([T.StructField("label", T.DoubleType())])).toPandas()
    if rows["label"].nunique() < 2:
        return None
    return grow_forest(rows[list(FEATURES)].to_numpy(), rows["label"].to_numpy(), list(FEATURES.values()))


def _verdicts(found: dict[str, np.ndarray], forest: Forest | None, threshold: float) -> dict[str, np.ndarray]:
    failed = (found["n_words"] < LEAST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED * found["n_words"])
    if forest is None:
        scores = np.where(failed, 0.0, 1.0)
    else:
        scores = forest.scores(np.stack([found[f] for f in FEATURES], axis=1))
    return {"base_failed": failed, "score": scores, "kept": ~failed & (scores >= threshold)}


def judge_quality(docs: DataFrame, forest: Forest | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the base counts, ``base_failed``, ``score`` and ``kept`` of every document."""
    names = [*BASE, "base_failed", "score", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            found = statistics(batch.column("text"))
            found |= _verdicts(found, forest, threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(found[n]) for n in names)], ["doc_id", *names]
            )

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in BASE) + ", base_failed boolean, score double, kept boolean"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def keep_good(docs: DataFrame, forest: Forest | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged; nothing is shuffled."""
    if dict(docs.dtypes)["text"] != "string":
        docs = docs.withColumn("text", F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            found = statistics(batch.column("text"))
            yield batch.filter(pa.array(_verdicts(found, forest, threshold)["kept"]))

    return docs.mapInArrow(run, docs.schema)
