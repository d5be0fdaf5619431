"""A quality classifier from trusted positives and unlabelled text.

The risk of a linear scorer is written with positives and unlabelled rows only: the negatives' part
is the unlabelled rows' loss less the positives' share of it.  That difference cannot be negative in
truth, so where a batch makes it so, the step goes against it instead of following it
(non-negative risk).  The class prior is estimated beforehand: a first scorer tells positives from
unlabelled rows, and on rows it has not seen, the least ratio of the two kinds' shares above a
threshold bounds the prior.

Texts become ``BUCKETS`` hashed byte trigrams (square roots of their shares) and the statistics
of :mod:`stats`.  At most ``TRAIN_ROWS`` rows of either kind are read for training, those whose ids
have the smallest hashes, none of them held out.  Labels, lang, source and doc_id enter no score.

Defined results: null and empty texts get the score of a text without trigrams and words; a null id
is never held out; repeated rows are scored alike; without positives every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedflow.llm.stats import FEATURES, statistics
from deedflow.llm.text import column_bytes, pieces
from deedflow.llm.tree_rules import in_training

BUCKETS = 512
TRAIN_ROWS = 6_000
EPOCHS, BATCH, RATE, DECAY = 40, 256, 0.02, 1e-4
THRESHOLD = 0.3


def features(column: pa.Array) -> np.ndarray:
    data, offsets = column_bytes(column)
    n = len(offsets) - 1
    rows = np.repeat(np.arange(n), np.diff(offsets))
    wide = data.astype(np.uint32)
    code = wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA77) + wide[2:] * np.uint32(0xC2B2AE3D)
    code = ((code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    inside = rows[:-2] == rows[2:]
    counts = np.bincount(rows[:-2][inside] * BUCKETS + code[inside], minlength=n * BUCKETS).reshape(n, BUCKETS)
    shares = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))
    found = statistics(column)
    rates = np.stack([found[f] for f in FEATURES], axis=1)
    return np.concatenate([shares, rates], axis=1).astype(np.float32)


@dataclass
class Scorer:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -5, 5)
        return _sigmoid(z @ self.weights + self.bias)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, seed: int = 7) -> Scorer:
    """Minimise the non-negative risk under ``prior``; None: tell positives from unlabelled rows."""
    both = np.concatenate([positive, unlabelled])
    centre, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    p, u = (np.clip((x - centre) / scale, -5, 5) for x in (positive, unlabelled))
    random = np.random.default_rng(seed)
    w = np.zeros(both.shape[1] + 1)
    first, second, step = np.zeros_like(w), np.zeros_like(w), 0
    mean = np.zeros_like(w)
    for epoch in range(EPOCHS):
        for _ in range(max(1, max(len(p), len(u)) // BATCH)):
            xp, xu = (x[random.integers(0, len(x), BATCH)] for x in (p, u))
            sp, su = (_sigmoid(x @ w[:-1] + w[-1]) for x in (xp, xu))
            pull = lambda x, s: np.append(x.T @ s, s.sum()) / len(s)
            if prior is None:
                g = pull(xp, sp - 1) + pull(xu, su)
            else:
                # Losses of calling a row negative: log(1 + e^z); positive: log(1 + e^-z).
                negative = -np.log1p(-su + 1e-12).mean() + prior * np.log1p(-sp + 1e-12).mean()
                part = pull(xu, su) - prior * pull(xp, sp)
                g = prior * pull(xp, sp - 1) + part if negative >= 0 else -part
            g[:-1] += DECAY * w[:-1]
            step += 1
            first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
            w -= RATE * (1 - epoch / EPOCHS) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            mean += w if epoch >= EPOCHS // 2 else 0
    # The mean over the second half of the steps; a single step's weights still sway.
    mean /= (EPOCHS - EPOCHS // 2) * max(1, max(len(p), len(u)) // BATCH)
    return Scorer(centre, scale, mean[:-1], float(mean[-1]))


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The largest share of positives that the unlabelled scores allow, by the best threshold."""
    cuts = np.quantile(positive, np.linspace(0, 0.95, 96))
    slack = lambda n: np.sqrt(np.log(40) / (2 * n))
    above_p = (positive[None, :] >= cuts[:, None]).mean(axis=1)
    above_u = (unlabelled[None, :] >= cuts[:, None]).mean(axis=1)
    bound = (above_u + slack(len(unlabelled)) + slack(len(positive))) / above_p
    best = int(np.argmin(bound))
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.95))


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> tuple[Scorer | None, float]:
    """The scorer and the estimated class prior."""

    def chosen(ids: DataFrame, kind: int) -> DataFrame:
        ids = ids.filter(in_training("_id")).distinct()
        return ids.orderBy(F.xxhash64("_id"), "_id").limit(most).withColumn("kind", F.lit(kind))

    trusted = chosen(labels.filter("quality = 1").select(F.col("doc_id").alias("_id")), 1)
    web = chosen(docs.select(F.col("doc_id").alias("_id")), 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            rows = pa.array([x.tobytes() for x in features(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("kind"), rows], ["doc_id", "kind", "x"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Both sides of the union are bounded by ``most`` rows, and so is what comes back: one row per id and kind.
    sample = texts.join(F.broadcast(trusted.unionByName(web)), F.col("doc_id") == F.col("_id")).drop("_id")
    found = sample.mapInArrow(run, "doc_id long, kind int, x binary").groupBy("doc_id", "kind").agg(F.min("x").alias("x"))
    rows = found.toPandas().sort_values(["kind", "doc_id", "x"])
    kinds = [np.frombuffer(b"".join(rows["x"][rows["kind"] == k]), np.float32).reshape(-1, BUCKETS + len(FEATURES)) for k in (1, 0)]
    positive, unlabelled = (np.random.default_rng(3).permutation(k) for k in kinds)
    if len(positive) < 4 or len(unlabelled) < 4:
        return None, 0.5
    half_p, half_u = len(positive) // 2, len(unlabelled) // 2
    first = fit(positive[:half_p], unlabelled[:half_u], None)
    prior = estimated_prior(first.scores(positive[half_p:]), first.scores(unlabelled[half_u:]))
    return fit(positive, unlabelled, prior), prior


def score_documents(docs: DataFrame, scorer: Scorer | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            n = batch.num_rows
            scores = np.full(n, 0.5) if scorer is None else scorer.scores(features(batch.column("text"))).astype(np.float64)
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(~in_training(), F.lit(False)).alias("held_out")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
