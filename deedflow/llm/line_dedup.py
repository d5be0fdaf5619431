"""Removal of repeated multi-line chunks whose bounds follow from their content, in DataFrame functions only.

Every line gets a hash.  A rolling hash over the last ``WINDOW`` line hashes ends a chunk after the
lines where it is a multiple of ``1 / SHARE``; since it sees these lines only, an insertion or
deletion moves the bounds near it and no others.  Chunks of at least ``LEAST_LINES`` lines whose hash
occurs again are compared byte by byte, and all but the first, by document and place, are removed.

Two passes keep texts out of the shuffles that see every chunk: the first counts chunk hashes, the
second carries the text of chunks with a repeated hash only.  Equal chunks are combined before they
are shuffled, so a chunk with a third of all rows is no load for one task.

Defined results: lines are separated by \\n; a null or empty text has no lines; a chunk without a word
is kept; a null id counts as larger than every other; of rows with one id, repeated or not, the order
is by text hash, and rows equal in both are kept or lose chunks together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedflow.llm.rows import distilled, id_or_last, written

WINDOW = 3
SHARE = 4
LEAST_LINES = 2
# Line hashes have 28 bits; the rolling hash mixes them by odd factors within 61 bits.
_MASK = (1 << 28) - 1
FACTORS = (1, 40503, 60493)


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def _with_lines(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id"), text.alias("_text"), id_or_last().alias("_id"), F.xxhash64(text).alias("_row"))
    empty = F.array().cast("array<string>")
    return rows.withColumn("_lines", F.when(F.length("_text") == 0, empty).otherwise(F.split("_text", "\n", -1)))


def _with_ends(rows: DataFrame) -> DataFrame:
    """``_ends``: the numbers (from 1) of the lines that end a chunk; the last line always does."""
    rows = rows.withColumn("_hashes", F.transform("_lines", line_hash))
    terms = [f"coalesce(get(_hashes, i - {j + 1}), 0) * {factor}L" for j, factor in enumerate(FACTORS)]
    cut = f"(({' + '.join(terms)}) div 8) % {SHARE} = 0 OR i = size(_hashes)"
    ends = f"CASE WHEN size(_hashes) = 0 THEN CAST(array() AS array<int>) ELSE filter(sequence(1, size(_hashes)), i -> {cut}) END"
    return rows.withColumn("_ends", F.expr(ends)).drop("_hashes")


def _chunks(rows: DataFrame) -> DataFrame:
    """One row per chunk of at least LEAST_LINES lines: document, first and last line, text."""
    bounds = "transform(_ends, (e, j) -> named_struct('a', CASE WHEN j = 0 THEN 1 ELSE _ends[j - 1] + 1 END, 'b', e))"
    long_ones = F.filter(F.expr(bounds), lambda c: c["b"] - c["a"] >= LEAST_LINES - 1)
    rows = rows.withColumn("_chunk", F.explode(long_ones))
    text = F.expr("array_join(slice(_lines, _chunk.a, _chunk.b - _chunk.a + 1), '\\n')")
    return rows.select("_id", "_row", F.col("_chunk.a").alias("_a"), F.col("_chunk.b").alias("_b"), text.alias("_chunk_text")).filter(
        F.col("_chunk_text").rlike(r"[^\x20\x09-\x0D]")
    )


def repeated_lines(docs: DataFrame) -> DataFrame:
    """Per document (``_id``, ``_row``) the ranges of lines to remove, ``_cuts`` as (a, b), both included."""
    found = _chunks(_with_ends(_with_lines(docs))).withColumn("_key", F.xxhash64("_chunk_text"))
    again = written(found.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_key"), "line-keys")
    carried = written(found.join(again, "_key", "left_semi"), "line-chunks")
    place = F.struct("_id", "_row", "_a")
    firsts = carried.groupBy("_key", "_chunk_text").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("n"))
    firsts = written(firsts.filter("n > 1").drop("n"), "line-firsts")
    later = carried.join(firsts, ["_key", "_chunk_text"]).filter(place != F.col("_first"))
    return later.groupBy("_id", "_row").agg(F.sort_array(F.collect_set(F.struct("_a", "_b"))).alias("_cuts"))


def without_repeated_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed (lines) and the kept text of every document."""
    cuts = distilled(docs.sparkSession, "line-cuts", lambda: repeated_lines(docs))
    # A merge join at any size: whole texts are shuffled once, never held against a table sent along.
    rows = _with_lines(docs).join(cuts.hint("merge"), ["_id", "_row"], "left")
    keep = "filter(_lines, (x, i) -> NOT exists(_cuts, c -> i + 1 BETWEEN c._a AND c._b))"
    kept = F.when(F.col("_cuts").isNull(), F.col("_lines")).otherwise(F.expr(keep))
    return rows.withColumn("_kept", kept).select(
        "doc_id", F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("long").alias("n_removed"),
        F.array_join("_kept", "\n").alias("kept_text"),
    )
