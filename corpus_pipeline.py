"""The corpus pipeline: its stages in order, each applied to what the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedflow.llm import decontaminate, mixing, near_dedup, sharding, tree_rules
from deedflow.llm.queries import DOMAIN, MIX_LEVELS, MIX_WEIGHTS, SHARDS
from deedflow.llm.rows import read, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# The mixture takes this part of the tokens, each document once at most.
MIX_SHARE = (9, 10)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the trees reject go."""
    return tree_rules.keep_good(docs, tree_rules.train(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return near_dedup.keep_one(docs)


def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.without_overlaps(docs, read(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each leaf's token prefix stays; the one document at which it ends is cut there."""
    # The columns are packed up, so that none clashes with those of the operator.
    packed = docs.select(
        "doc_id", F.struct(*docs.columns).alias("doc"), "lang", "source",
        F.expr(DOMAIN).alias("domain"), mixing.word_count().alias("n_tokens"),
    )
    rows = mixing.mix(packed, MIX_LEVELS, MIX_WEIGHTS, share=MIX_SHARE, max_epochs=1, seed=17)
    rows = rows.select("doc.*", F.struct("n_tokens", "taken_tokens").alias("_mix"))
    cut = F.col("_mix.taken_tokens") < F.col("_mix.n_tokens")
    rows = rows.withColumn("text", F.when(cut, mixing.first_words("text", "_mix.taken_tokens")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(cut, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document goes."""
    return sharding.shard_documents(docs, shards=SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_overlap", benchmark_overlap),
    ("mixture", mixture),
    ("shards", shards),
]

# Boosted trees have no form in SQL; ``tests/llm`` goes through the stages by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
