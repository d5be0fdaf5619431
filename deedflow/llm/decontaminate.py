"""Benchmark decontamination by spaced seeds.

Each mask keeps 6 of 12 consecutive words, so a hit survives substitutions at the other places.
Seeds of the test items are held against the seeds at every position of every text; around a hit the
two texts are compared word by word along its diagonal.  A pair counts if a stretch of ``STRETCH``
words (the whole item if shorter) that contains the hit has at least 80 % equal words.  The masks
miss no such stretch (``tests/llm`` goes through all substitutions).

Test items are the query set: they are taken in blocks of about ``BLOCK_WORDS`` words, and each
block's seeds go to the tasks, so what is sent is bounded whatever the benchmark's size.

Defined results: words are compared with A-Z lowered; items shorter than a seed but of at least
``LEAST_WORDS`` words must occur whole and unchanged, shorter ones match nothing; null and empty texts
match nothing; repeated rows give repeated pairs; null ids are carried.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedflow.llm.text import mixed, pieces, windows, word_hashes, words_of

SPAN = 12
# The places each mask keeps.  Whatever 2 of 12 to 14 words or 3 of 15 or 16 are substituted, one mask
# at one position is untouched.
MASKS = (
    (0, 1, 4, 8, 10, 11),
    (0, 2, 7, 9, 10, 11),
    (0, 3, 5, 6, 10, 11),
    (1, 2, 4, 7, 8, 9),
    (1, 3, 4, 5, 6, 8),
    (2, 3, 5, 6, 7, 9),
)
STRETCH = 16
LEAST_WORDS = 8
BLOCK_WORDS = 250_000
_BITS = 22


@dataclass
class Items:
    """A block of test items, their words in one array."""

    ids: list
    words: np.ndarray
    bounds: np.ndarray


def masked(hashes: np.ndarray, starts: np.ndarray, mask: int) -> np.ndarray:
    """Seeds of one mask at the given first words; different masks never meet."""
    total = np.full(len(starts), mask + 1, np.uint64)
    for place in MASKS[mask]:
        total *= np.uint64(0xD6E8FEB86659FD93)
        total += hashes[starts + place]
    return mixed(total)


class Seeds:
    """Sorted seeds of a block, with a bit table before the search."""

    def __init__(self, items: Items):
        lengths = np.diff(items.bounds)
        rows = np.repeat(np.arange(len(lengths)), lengths)
        self.items = items
        self.long = [self._table(self._of_mask(rows, mask)) for mask in range(len(MASKS))]
        self.short = {}
        for n in sorted({int(n) for n in lengths if LEAST_WORDS <= n < SPAN}):
            hashes, at = windows(items.words, rows, n)
            whole = lengths[rows[at]] == n
            self.short[n] = self._table((hashes[whole], at[whole]))

    def _of_mask(self, rows: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
        at = _starts(rows, SPAN)
        return masked(self.items.words, at, mask), at

    @staticmethod
    def _table(seeds: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes, at = seeds
        order = np.argsort(hashes, kind="stable")
        bits = np.zeros(1 << _BITS, bool)
        bits[(hashes & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True
        return hashes[order], at[order], bits


def _starts(rows: np.ndarray, width: int) -> np.ndarray:
    n = len(rows) - width + 1
    return np.flatnonzero(rows[:n] == rows[width - 1 :]) if n > 0 else np.zeros(0, np.int64)


def _hits(hashes: np.ndarray, at: np.ndarray, table: tuple) -> Iterator[tuple[int, int]]:
    """Pairs of a text's word and an item's word at which equal seeds begin."""
    seeds, places, bits = table
    maybe = np.flatnonzero(bits[(hashes & np.uint64((1 << _BITS) - 1)).astype(np.int64)])
    first = np.searchsorted(seeds, hashes[maybe], side="left")
    last = np.searchsorted(seeds, hashes[maybe], side="right")
    for i in np.flatnonzero(last > first):
        for place in places[first[i] : last[i]]:
            yield int(at[maybe[i]]), int(place)


def best_stretch(equal: np.ndarray, length: int, within: tuple[int, int]) -> int:
    """Most equal words in a stretch of ``length`` that contains the places ``within`` (end exclusive)."""
    sums = np.concatenate([[0], np.cumsum(equal)])
    low, high = max(0, within[1] - length), min(within[0], len(equal) - length)
    return int((sums[low + length : high + length + 1] - sums[low : high + 1]).max()) if high >= low else 0


def overlaps(seeds: Seeds, batch: pa.RecordBatch) -> dict[tuple[int, int], tuple[int, int]]:
    """For rows and items that overlap: equal words in the best stretch, and along its whole diagonal."""
    items, words = seeds.items, words_of(batch.column("text"), lower=True)
    hashes, rows = word_hashes(words), words.rows
    found: dict[tuple[int, int], set] = defaultdict(set)
    starts = _starts(rows, SPAN)
    tables = [(masked(hashes, starts, mask), starts, table, SPAN) for mask, table in enumerate(seeds.long)]
    tables += [(*windows(hashes, rows, n), table, n) for n, table in seeds.short.items()]
    for own, at, table, width in tables:
        for word, place in _hits(own, at, table):
            item = int(np.searchsorted(items.bounds, place, side="right")) - 1
            found[int(rows[word]), item].add((word - place, place, width))
    out = {}
    for (row, item), hits in found.items():
        first, end = int(items.bounds[item]), int(items.bounds[item + 1])
        need = min(STRETCH, end - first)
        by_diagonal = defaultdict(list)
        for shift, place, width in hits:
            by_diagonal[shift].append((place, width))
        for shift, places in by_diagonal.items():
            low = max(first, int(words.bounds[row]) - shift)
            high = min(end, int(words.bounds[row + 1]) - shift)
            equal = items.words[low:high] == hashes[low + shift : high + shift]
            most = max(best_stretch(equal, need, (p - low, p - low + w)) for p, w in places)
            if most * 5 >= need * 4:
                out[row, item] = max(out.get((row, item), (0, 0)), (most, int(equal.sum())))
    return out


def _item_blocks(items: DataFrame) -> Iterator[Items]:
    """The test items, in blocks of a bounded number of words."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            words = words_of(batch.column("text"), lower=True)
            hashes = word_hashes(words)
            parts = [hashes[a:b].tobytes() for a, b in zip(words.bounds, words.bounds[1:], strict=False)]
            counts = pa.array(words.counts, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), counts, pa.array(parts, pa.binary())], ["item_id", "n", "words"]
            )

    texts = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    table = texts.mapInArrow(hashed, "item_id long, n long, words binary").filter(f"n >= {LEAST_WORDS}")
    total = table.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // BLOCK_WORDS)
    for block in range(blocks):
        rows = table.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == block).collect()
        arrays = [np.frombuffer(r.words, np.uint64) for r in rows]
        if rows:
            bounds = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
            yield Items([r.item_id for r in rows], np.concatenate(arrays), bounds)


_PAIR = "doc_id long, item_id long, n_equal long, n_equal_total long"


def find_overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and test item that overlap."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for block in _item_blocks(items):
        found = texts.mapInArrow(_task(docs, block, _pair_rows), _PAIR)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], _PAIR) if out is None else out


def without_overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without those that overlap a test item; nothing is shuffled."""
    if dict(docs.dtypes)["text"] != "string":
        docs = docs.withColumn("text", F.col("text").cast("string"))
    schema = docs.schema
    for block in _item_blocks(items):
        docs = docs.mapInArrow(_task(docs, block, _clean_rows), schema)
    return docs


def _task(docs: DataFrame, block: Items, make: Callable) -> Callable:
    sent = docs.sparkSession.sparkContext.broadcast((block.ids, block.words, block.bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = Seeds(Items(*sent.value))
        for batch in (p for b in batches for p in pieces(b)):
            yield make(seeds, batch)

    return run


def _pair_rows(seeds: Seeds, batch: pa.RecordBatch) -> pa.RecordBatch:
    found = sorted(overlaps(seeds, batch).items())
    ids = batch.column("doc_id").take(pa.array([row for (row, _), _ in found], pa.int64()))
    others = [pa.array([seeds.items.ids[item] for (_, item), _ in found], pa.int64())]
    others += [pa.array([counts[i] for _, counts in found], pa.int64()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays([ids, *others], ["doc_id", "item_id", "n_equal", "n_equal_total"])


def _clean_rows(seeds: Seeds, batch: pa.RecordBatch) -> pa.RecordBatch:
    clean = np.ones(batch.num_rows, bool)
    clean[[row for row, _ in overlaps(seeds, batch)]] = False
    return batch.filter(pa.array(clean))
