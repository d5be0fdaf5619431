"""Removal of long passages that an earlier document has, over a De Bruijn graph of the corpus's words.

Windows of ``WINDOW`` words are the graph's edges (between their first and last ``WINDOW - 1`` words).
An edge belongs to its first place in the corpus; places are packed into one number, so the first one
is the least.  Two edges are on one path if the graph does not branch between them: wherever the one
is, the other follows, and nothing else comes before that.  This is read off fingerprints of their
places, so that texts that begin or end there count as branches too.  Paths are then contracted by
joins (:func:`compacted`), and only the first edge of each is looked up in later documents, where
all of the path follows it.  Paths that follow one another there as at their first places make one
span, whatever its length.  Every span is held against the words at its first place by a 128-bit
digest before its words are removed; those that differ are judged again window by window.

A text that a smaller id has too is one path from the start and gives no edges.  Of the others, only
windows that can repeat are shuffled.  Each window is represented by the least hash of its
``GRAM``-word parts, which neighbours mostly share; a window whose least part occurs in one text
only is in that text only.  Those parts are a sixth of all windows, and counting them leaves few
windows besides the truly repeated ones.  Hot windows and parts are counted before they are shuffled;
joins have stored rows on both sides, so that Spark can split hot keys.

Defined results: a null text has no words; a null id counts as larger than every other; rows of one id
remove nothing from each other, whether they are repeated or differ in text; an empty table gives no
rows; where two windows of different words have equal 64-bit hashes, all places of such windows are
judged again by 128-bit digests of their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deedflow.llm.rows import distilled, id_or_last, written
from deedflow.llm.text import Words, mixed, pieces, windows, word_hashes, words_of

WINDOW = 13
GRAM = 4
# A place is the document's number times 2^PLACE_BITS plus the number of the word.
PLACE_BITS = 28
# The length of a path that is a whole text.
WHOLE = -1


def least_parts(hashes: np.ndarray, rows: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """For each window the least hash of its parts, and its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    parts = hashes[: len(hashes) - GRAM + 1].copy()
    for j in range(1, GRAM):
        parts *= np.uint64(0xD6E8FEB86659FD93)
        parts += hashes[j : len(hashes) - GRAM + 1 + j]
    parts = mixed(parts)
    least = parts[:n].copy()
    for j in range(1, width - GRAM + 1):
        np.minimum(least, parts[j : j + n], out=least)
    at = np.flatnonzero(rows[:n] == rows[width - 1 :])
    return least[at], at


def _distinct_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct least parts, and the texts' rows."""
    words = words_of(column)
    least, at = least_parts(word_hashes(words), words.rows)
    owners = words.rows[at]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (owners[1:] != owners[:-1])
    least, owners = least[new], owners[new]
    own = mixed(least + owners.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    first = np.sort(np.unique(own, return_index=True)[1])
    return least[first], owners[first]


def _sources(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    row = F.xxhash64(F.coalesce(text, F.lit("")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), id_or_last().alias("id"), row.alias("row"), text.alias("text"))


def _parts(docs: DataFrame) -> DataFrame:
    """(part, id, row) for the distinct least parts of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            parts, owners = _distinct_parts(batch.column("text"))
            own = [batch.column(c).take(pa.array(owners)) for c in ("id", "row")]
            yield pa.RecordBatch.from_arrays([pa.array(parts.view(np.int64)), *own], ["part", "id", "row"])

    return _sources(docs).select("id", "row", "text").mapInArrow(run, "part long, id long, row long")


def numbered(docs: DataFrame) -> DataFrame:
    """(id, row, num, low): texts numbered from 0 by id, and the first number of each id.

    Ranges of ids are counted, then shifted, so no task sees them all.
    """
    keys = _sources(docs).select("id", "row").distinct()
    ranges = written(keys.repartitionByRange("id", "row").withColumn("part", F.spark_partition_id()), "ids")
    line = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the keys.
    starts = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn("start", F.coalesce(F.sum("n").over(line), F.lit(0)))
    inside = Window.partitionBy("part").orderBy("id", "row")
    rows = ranges.withColumn("place", F.row_number().over(inside) - 1).join(starts, "part")
    rows = written(rows.select("id", "row", (F.col("start") + F.col("place")).cast("long").alias("num")), "numbers")
    lows = written(rows.groupBy("id").agg(F.min("num").alias("low")), "lows")
    return rows.join(lows, "id").select("id", "row", "num", "low")


def _copies(numbers: DataFrame) -> DataFrame:
    """Paths that are a whole text, which a smaller id has too."""
    same = numbers.groupBy("row").agg(F.min("num").alias("source"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = numbers.join(written(same.drop("n"), "same-texts"), "row").filter("source < low")
    return copies.select("num", F.lit(0).cast("long").alias("start"), F.lit(WHOLE).cast("long").alias("length"), "source", F.lit(0).cast("long").alias("source_start"))


def _edges(docs: DataFrame, numbers: DataFrame) -> DataFrame:
    """(edge, at, low) for every window that may repeat: its hash, its place and its id's first number."""
    parts = _parts(docs)
    texts = parts.groupBy("part").agg(F.min("row").alias("a"), F.max("row").alias("b"))
    repeated = written(texts.filter("a <> b").select("part"), "parts")
    marks = parts.join(repeated, "part").groupBy("id", "row").agg(F.collect_set("part").alias("parts"))
    marks = written(marks.join(numbers, ["id", "row"]), "marks")
    texts = _sources(docs).dropDuplicates(["id", "row"]).join(marks.hint("merge"), ["id", "row"]).select("num", "low", "text", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            words = words_of(batch.column("text"))
            hashes, rows = word_hashes(words), words.rows
            edges, at = windows(hashes, rows, WINDOW)
            least, _ = least_parts(hashes, rows)
            marked = batch.column("parts")
            owners = np.repeat(np.arange(batch.num_rows), marked.value_lengths().to_numpy(zero_copy_only=False))
            own = lambda h, r: mixed(h + r.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            known = marked.flatten().to_numpy().view(np.uint64)
            kept = np.isin(own(least, rows[at]), own(known, owners))
            edges, at = edges[kept], at[kept]
            places = at - words.bounds[rows[at]]
            number = batch.column("num").to_numpy()[rows[at]] << PLACE_BITS
            low = batch.column("low").take(pa.array(rows[at]))
            yield pa.RecordBatch.from_arrays([pa.array(edges.view(np.int64)), pa.array(number + places), low], ["edge", "at", "low"])

    return texts.mapInArrow(run, "edge long, at long, low long")


def _number(at: Column | str) -> Column:
    return F.shiftright(at, PLACE_BITS)


def repeated_edges(edges: DataFrame) -> DataFrame:
    """(edge, first, here, before): edges that a larger id has too, and fingerprints of their places and of those before."""
    places = edges.groupBy("edge").agg(
        F.min("at").alias("first"), F.max("low").alias("last"),
        F.bit_xor(F.xxhash64("at")).alias("here"), F.bit_xor(F.xxhash64(F.col("at") - 1)).alias("before"),
    )
    return places.filter(_number("first") < F.col("last")).select("edge", "first", "here", "before")


def compacted(edges: DataFrame) -> DataFrame:
    """(edge, first, length): the nonbranching paths of ``edges``, each with its first edge and its number of edges.

    An edge's places are those of the next one less a word exactly if the graph does not branch between the two, and then
    their first places adjoin as well.  Paths that meet at an odd place are joined first, then those that meet at an
    odd multiple of two, of four, and so on: a path lies between two multiples of the step, so it has one neighbour at
    most in a round.  Paths no end of which is a multiple of the next step are complete; the others are halved in
    number by each round, and there are as many rounds as the number of a word has bits.
    """
    paths = edges.select("edge", "first", (F.col("first") + 1).alias("end"), "before", "here")
    complete = []
    for level in range(PLACE_BITS):
        step = 1 << level
        meets = {c: F.col(c).bitwiseAND(2 * step - 1) == step for c in ("first", "end")}
        left = paths.filter(meets["end"]).select("edge", "first", "before", F.col("end").alias("at"), F.col("here").alias("mark"))
        right = paths.filter(meets["first"]).select(
            F.col("edge").alias("r_edge"), F.col("first").alias("at"), "end", F.col("before").alias("mark"), "here"
        )
        joined = left.join(right.withColumn("r_first", F.col("at")), ["at", "mark"], "full_outer").select(
            F.coalesce("edge", "r_edge").alias("edge"), F.coalesce("first", "r_first").alias("first"),
            F.coalesce("end", "at").alias("end"), F.coalesce("before", "mark").alias("before"), F.coalesce("here", "mark").alias("here"),
        )
        rows = written(joined.unionByName(paths.filter(~meets["first"] & ~meets["end"])), "path-level")
        further = {c: F.col(c).bitwiseAND(2 * step - 1) == 0 for c in ("first", "end")}
        further = further["end"] | (further["first"] & (F.col("first").bitwiseAND((1 << PLACE_BITS) - 1) > 0))
        complete.append(rows.filter(~further))
        paths = rows.filter(further)
        if paths.isEmpty():
            break
    else:
        complete.append(paths)
    return reduce(DataFrame.unionByName, complete).select("edge", "first", (F.col("end") - F.col("first")).alias("length"))


def _walks(edges: DataFrame, paths: DataFrame) -> DataFrame:
    """Where later documents go along ``paths``, with paths that adjoin there and at their first places as one span."""
    later = edges.join(paths, "edge").filter(_number("first") < F.col("low"))
    later = later.select(_number("at").alias("num"), "at", (F.col("at") - F.col("first")).alias("shift"), "length")
    line = Window.partitionBy("num", "shift").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    steps = later.withColumn("run", F.col("at") - F.coalesce(F.sum("length").over(line), F.lit(0)))
    ends = steps.groupBy("num", "shift", "run").agg(F.min("at").alias("low"), F.max(F.col("at") + F.col("length")).alias("high"))
    mask = F.lit((1 << PLACE_BITS) - 1)
    source = F.col("low") - F.col("shift")
    return ends.select(
        "num", F.col("low").bitwiseAND(mask).alias("start"), (F.col("high") - F.col("low") + WINDOW - 1).alias("length"),
        _number(source).alias("source"), source.bitwiseAND(mask).alias("source_start"),
    )


def spans_of(docs: DataFrame, numbers: DataFrame, copies: DataFrame) -> DataFrame:
    """(num, start, length, source, source_start): repeated passages, in words, and where they come from first."""
    edges = distilled(docs.sparkSession, "edges", lambda: _edges(docs, numbers.join(copies, "num", "left_anti")))
    repeated = written(repeated_edges(edges), "repeated-edges")
    paths = distilled(docs.sparkSession, "compacted", lambda: compacted(repeated))
    return _walks(edges, paths).unionByName(copies)


def _judged_again(docs: DataFrame, numbers: DataFrame, copies: DataFrame, wrong: DataFrame) -> DataFrame:
    """Spans of every document along windows that are in ``wrong`` spans, told apart by digests of their words."""
    edges = written(_edges(docs, numbers.join(copies, "num", "left_anti")), "edges").withColumn("num", _number("at"))
    place = F.shiftleft("num", PLACE_BITS) + F.col("start")
    inside = wrong.filter(F.col("length") >= WINDOW).select(F.explode(F.sequence(place, place + F.col("length") - WINDOW)).alias("at"))
    whole = wrong.filter(F.col("length") == WHOLE).select("num")
    suspects = edges.join(inside, "at", "left_semi").select("edge").union(edges.join(whole, "num", "left_semi").select("edge"))
    suspects = written(suspects.distinct(), "suspects")
    places = edges.join(suspects, "edge", "left_semi").groupBy("num").agg(F.collect_list("at").alias("places"))
    places = written(places.join(numbers, "num"), "suspect-places")
    texts = _sources(docs).dropDuplicates(["id", "row"]).join(places.hint("merge"), ["id", "row"]).select("num", "low", "text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            words = words_of(batch.column("text"))
            plain = Plain(words)
            marked = batch.column("places")
            owners = np.repeat(np.arange(batch.num_rows), marked.value_lengths().to_numpy(zero_copy_only=False))
            at = marked.flatten().to_numpy()
            starts = at & ((1 << PLACE_BITS) - 1)
            digests = [_digest(plain, words, row, start, WINDOW) for row, start in zip(owners.tolist(), starts.tolist(), strict=True)]
            low = batch.column("low").take(pa.array(owners))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(at), low], ["edge", "at", "low"])

    exact = written(texts.mapInArrow(run, "edge binary, at long, low long"), "exact-edges")
    return _walks(exact, repeated_edges(exact).select("edge", "first", F.lit(1).cast("long").alias("length")))


class Plain:
    """The words of texts joined by single spaces, and where each word begins in that."""

    def __init__(self, words: Words, chosen: np.ndarray | None = None):
        sizes = words.ends - words.starts
        keep = np.ones(len(sizes), bool) if chosen is None else chosen
        mark = np.zeros(len(words.data) + 1, np.int8)
        mark[words.starts[keep]] = 1
        mark[words.ends[keep]] -= 1
        solid = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
        sizes = sizes[keep]
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.bytes = np.full(self.starts[-1], 32, np.uint8)
        self.bytes[np.arange(sizes.sum()) + np.repeat(np.arange(len(sizes)), sizes)] = words.data[solid]
        self.bounds = np.concatenate([[0], np.cumsum(keep)])[words.bounds]

    def text(self, first: int, last: int) -> bytes:
        """Words ``first`` to ``last`` (exclusive), numbered over all texts."""
        return self.bytes[self.starts[first] : max(self.starts[first], self.starts[last] - 1)].tobytes()


_DIGEST = "array<struct<source:long,start:long,length:long,digest:binary>>"
_OUT = f"doc_id long, num long, n_words long, n_removed long, kept_sha256 string, kept_text string, claims {_DIGEST}, answers {_DIGEST}"
_CLAIM = pa.list_(pa.struct([("source", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("digest", pa.binary())]))


def _digest(plain: Plain, words: Words, row: int, start: int, length: int) -> bytes:
    first = int(words.bounds[row]) + start
    last = int(words.bounds[row + 1]) if length == WHOLE else first + length
    return hashlib.blake2b(plain.text(first, last), digest_size=16).digest()


def _apply(docs: DataFrame, numbers: DataFrame, spans: DataFrame, with_text: bool) -> DataFrame:
    """Every row with its paths removed, digests of these, and digests that other documents ask for."""
    own = spans.groupBy("num").agg(F.collect_list(F.struct("start", "length", "source", "source_start")).alias("spans"))
    asked = spans.select(F.col("source").alias("num"), "source_start", "length").distinct()
    asked = asked.groupBy("num").agg(F.collect_list(F.struct("source_start", "length")).alias("asked"))
    work = written(numbers.join(own, "num", "left").join(asked, "num", "left").filter("spans IS NOT NULL OR asked IS NOT NULL"), "path-work")
    # Merge joins at any size: whole texts are shuffled, never held against a table sent along.
    rows = _sources(docs).join(work.hint("merge"), ["id", "row"], "left").select("doc_id", "num", "text", "spans", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            words = words_of(batch.column("text"))
            plain = Plain(words)
            cover = np.zeros(len(words.starts) + 1, np.int64)
            claims, answers = [], []
            for row, (num, spans_, asked_) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("num", "spans", "asked")), strict=True)):
                claimed = []
                for s in spans_ or ():
                    length = int(words.counts[row]) if s["length"] == WHOLE else s["length"]
                    if length < WINDOW:
                        continue
                    first = int(words.bounds[row]) + s["start"]
                    cover[first] += 1
                    cover[first + length] -= 1
                    found = _digest(plain, words, row, s["start"], length)
                    claimed.append({"source": s["source"], "start": s["source_start"], "length": s["length"], "digest": found})
                claims.append(claimed)
                answers.append(
                    [
                        {"source": num, "start": a["source_start"], "length": a["length"],
                         "digest": _digest(plain, words, row, a["source_start"], a["length"])}
                        for a in asked_ or ()
                    ]
                )
            removed = np.cumsum(cover[:-1]) > 0
            gone = np.bincount(words.rows[removed], minlength=batch.num_rows)
            if removed.any():
                plain = Plain(words, ~removed)
            texts = [plain.text(a, b) for a, b in zip(plain.bounds, plain.bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("num"), pa.array(words.counts), pa.array(gone),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                    pa.array([t.decode() for t in texts] if with_text else [None] * len(texts), pa.string()),
                    pa.array(claims, _CLAIM), pa.array(answers, _CLAIM),
                ],
                ["doc_id", "num", "n_words", "n_removed", "kept_sha256", "kept_text", "claims", "answers"],
            )

    return rows.mapInArrow(run, _OUT)


def without_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept words of every row."""
    spark = docs.sparkSession
    numbers = distilled(spark, "numbers", lambda: numbered(docs))
    copies = written(_copies(numbers), "copies")
    spans = distilled(spark, "spans", lambda: spans_of(docs, numbers, copies))
    rows = distilled(spark, "judged", lambda: _apply(docs, numbers, spans, with_text))
    said = rows.select(F.explode("answers").alias("x")).select("x.*")
    wrong = rows.select("num", F.explode("claims").alias("x")).select("num", "x.*")
    wrong = wrong.join(said, ["source", "start", "length", "digest"], "left_anti")
    wrong = written(wrong.select("num", "source", F.col("start").alias("source_start"), "length").distinct(), "wrong-spans")
    if not wrong.isEmpty():
        keys = ["num", "source", "source_start", "length"]
        bad = written(spans.join(wrong, keys), "bad-spans")
        true_copies = written(copies.join(wrong, keys, "left_anti"), "true-copies")
        again = distilled(spark, "spans-again", lambda: _judged_again(docs, numbers, true_copies, bad))
        true = written(spans.join(wrong, keys, "left_anti").unionByName(again), "true-spans")
        rows = distilled(spark, "judged", lambda: _apply(docs, numbers, true, with_text))
    return rows.select("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text")
