"""Spelling variants: words that differ by one letter, found by the letter counts they are made of.

A word's vector counts its letters by group; the vectors of all words, read group by group, are the paths of a trie.
One edit adds one letter (a surplus), takes one away (a deficit) or does both, so the words near a given one lie at the
ends of paths that leave its own by a budget of one surplus and one deficit.  The trie's upper levels are walked by
Spark, as a join of each word with the upper paths within its budget; below, a task holds one subtree and searches it
depth first.  A crowded subtree is not held: there Spark walks the lower levels too, down to single paths, and what
shares a path is dealt out by first and last halves of the words, one of which a near word must share.

A pair is looked for from one side only: from its shorter word, or if both are of one length, from the one whose vector
has the surplus in an earlier group than the deficit.  Words at the ends are verified letter by letter.

Null texts have no words, empty tables give no rows, and rows with repeated or null ids count like all others (a null
id is written as nothing before the colon).  Other columns are left alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deedflow.llm.rows import distilled, written
from deedflow.llm.text import _LOWER, column_bytes, pieces

LEAST_LETTERS = 7
LEAST_COPIES = 2
# Every so-many-th run, by its checksum, has lost a letter.
DAMAGED = 31
# A form occurs so many times as often as its variants.
RATIO = 10

GROUPS = 16
# Levels of the trie: groups with frequent letters first, as they tell words apart early.
LEVELS = (5, 1, 9, 14, 4, 15, 3, 2, 12, 8, 13, 7, 6, 0, 11, 10)
# Spark walks so many upper levels at most; fewer if no upper path is crowded then.
MOST_TOP = 8
# An upper path with more words than this is crowded: it is not searched in one task.
SHARD_WORDS = 50_000
# Counted words are passed on when a task holds more different ones than this.
HELD_WORDS = 500_000
# Forms grow by RATIO at each step, so that no chain of 64-bit counts is longer than 2 to this power.
DOUBLINGS = 5

BOTH, DEFICIT, NOTHING = 0, 1, 2

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LEAD = 0xC3


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte (exclusive) of the runs of letters a to z and U+00C0 to U+00FF; ``data`` in lower case."""
    inside = _LETTER[data]
    lead = data == _LEAD
    inside |= lead
    inside[1:] |= lead[:-1]
    # One place more than bytes: runs end where a text does.
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    runs = inside[starts]
    return starts[runs], ends[runs]


def run_checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each run's bytes, carried on from the checksum ``before`` it."""
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    ordered, first = sizes[order], starts[order]
    state = ~before[order].astype(np.uint32)
    long = int(np.searchsorted(-ordered, -64, side="left"))
    for j in range(int(ordered[long]) if long < len(order) else 0):
        end = int(np.searchsorted(-ordered, -j, side="left"))
        part = state[long:end]
        state[long:end] = _CRC[(part ^ data[first[long:end] + j]) & 255] ^ (part >> np.uint32(8))
    state = ~state
    for i in range(long):
        run = data[first[i] : first[i] + ordered[i]].tobytes()
        state[i] = zlib.crc32(run, int(before[order[i]]))
    out = np.empty(len(order), np.uint32)
    out[order] = state
    return out


def _gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as texts."""
    sizes = ends - starts
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    places = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[places].tobytes())]
    return pa.Array.from_buffers(pa.large_string(), len(sizes), buffers)


def _words_in(batch: pa.RecordBatch) -> pa.Array:
    """The words of long enough runs, some of them damaged."""
    raw, offsets = column_bytes(batch.column("text"))
    data = _LOWER[raw]
    starts, ends = letter_runs(data, offsets)
    leads = np.concatenate([[0], np.cumsum(data == _LEAD, dtype=np.int64)])
    letters = ends - starts - (leads[ends] - leads[starts])
    enough = letters >= LEAST_LETTERS
    starts, ends, letters = starts[enough], ends[enough], letters[enough]
    rows = np.searchsorted(offsets, starts, side="right") - 1
    ids = batch.column("doc_id").to_pylist()
    before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    checks = run_checksums(data, starts, ends, before[rows])
    hit = checks % DAMAGED == 0
    damaged = []
    for i in np.flatnonzero(hit & (letters > LEAST_LETTERS)):
        run = data[starts[i] : ends[i]].tobytes().decode()
        at = int(checks[i]) % len(run)
        damaged.append(run[:at] + run[at + 1 :])
    return pa.concat_arrays([_gathered(data, starts[~hit], ends[~hit]), pa.array(damaged, pa.large_string())])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    rows = 0

    def summed() -> pa.Table:
        table = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
        return table.select(["word", "n_sum"]).rename_columns(["word", "n"])

    for batch in batches:
        for piece in pieces(batch):
            counts = _words_in(piece).value_counts()
            held.append(pa.table({"word": counts.field("values"), "n": counts.field("counts")}))
            rows += len(counts)
            if rows > HELD_WORDS:
                held[:] = [summed()]
                rows = len(held[0])
                if rows > HELD_WORDS // 2:
                    yield from held.pop().to_batches(10_000)
                    rows = 0
    if held:
        yield from summed().to_batches(10_000)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and its number of occurrences ``n``; rare and short words are left out."""
    counted = docs.select("doc_id", "text").mapInArrow(_count_words, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COPIES)


_LEVEL_OF = bytes(LEVELS.index(code % GROUPS) for code in range(256))


def vector(word: str) -> bytes:
    """Letter counts by level, modulo 256.  Characters beyond U+00FF share a group."""
    levels = word.encode("latin-1", "replace").translate(_LEVEL_OF)
    return bytes([levels.count(level) & 255 for level in range(GROUPS)])


def changed(counts: bytes, budget: int) -> list[tuple[bytes, int]]:
    """The counts within the budget, each with what is left of it; the surplus comes on an earlier level."""
    found = [(counts, budget)]
    for i in range(len(counts)) if budget == BOTH else ():
        more = counts[:i] + bytes([(counts[i] + 1) & 255]) + counts[i + 1 :]
        found.append((more, DEFICIT))
        found.extend((more[:j] + bytes([counts[j] - 1]) + more[j + 1 :], NOTHING) for j in range(i + 1, len(counts)) if counts[j])
    for j in range(len(counts)) if budget == DEFICIT else ():
        if counts[j]:
            found.append((counts[:j] + bytes([counts[j] - 1]) + counts[j + 1 :], NOTHING))
    return found


def longer(budget: int, left: int) -> int:
    """By how many letters a word is longer whose path has ``left`` of a budget."""
    return {BOTH: 0, DEFICIT: 1, NOTHING: 0}[left] - {BOTH: 0, DEFICIT: 1, NOTHING: 0}[budget]


VECTOR = "word string, n long, counts binary"
PLACED = "word string, n long, budget int, upper binary, lower binary"
KEYED = "word string, n long, budget int, key binary, lower binary"


def _arrow(rows: list[tuple], names: str) -> pa.RecordBatch:
    kinds = {"word": pa.string(), "near": pa.string(), "n": pa.int64(), "near_n": pa.int64(), "budget": pa.int32()}
    fields = [pa.field(name, kinds.get(name, pa.binary())) for name in names.split()]
    arrays = [pa.array(column, field.type) for column, field in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = pa.array(map(vector, batch.column(0).to_pylist()), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), counts], ["word", "n", "counts"])


def _placed(words: DataFrame, top: int) -> DataFrame:
    """Where each word lies (no budget given), and the upper paths under which near words may lie."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach: dict[bytes, list[tuple[bytes, int]]] = {}
        for batch in batches:
            rows = []
            for word, n, counts in zip(*(column.to_pylist() for column in batch.columns)):
                upper, lower = counts[:top], counts[top:]
                if upper not in reach:
                    if len(reach) > 10_000:
                        reach.clear()
                    reach[upper] = changed(upper, BOTH)
                rows.append((word, n, None, upper, lower))
                rows.extend([(word, n, left, path, lower) for path, left in reach[upper]])
                if len(rows) > 20_000:
                    yield _arrow(rows, "word n budget upper lower")
                    rows = []
            if rows:
                yield _arrow(rows, "word n budget upper lower")

    return words.mapInArrow(place, PLACED)


def _halves(word: str, path: bytes, length: int) -> Iterator[bytes]:
    half = (length - 1) // 2
    yield path + b"first" + word[:half].encode()
    yield path + b"last" + word[-half:].encode()


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lower levels of crowded upper paths: keys of single paths and halves of words."""
    for batch in batches:
        rows = []
        for word, n, budget, upper, lower in zip(*(column.to_pylist() for column in batch.columns)):
            if budget is None:
                rows.extend((word, n, None, key, b"") for key in _halves(word, upper + lower, len(word)))
            else:
                size = len(word) + longer(BOTH, budget)
                for path, left in changed(lower, budget):
                    keys = _halves(word, upper + path, size + longer(budget, left))
                    rows.extend((word, n, left, key, b"") for key in keys)
            if len(rows) > 20_000:
                yield _arrow(rows, "word n budget key lower")
                rows = []
        if rows:
            yield _arrow(rows, "word n budget key lower")


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted or replaced letter turns ``a`` into ``b``; ``b`` is not the shorter one."""
    if a == b or not 0 <= len(b) - len(a) <= 1:
        return False
    i, most = 0, len(a)
    while i < most and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


class Leaf:
    """The words of one path; where they are many, by their first and last halves."""

    FEW = 16

    def __init__(self, counts: bytes) -> None:
        self.counts = counts
        self.words: list[tuple[str, int]] = []
        self.halves: dict[tuple[bool, str], list[tuple[str, int]]] | None = None

    def near(self, word: str) -> list[tuple[str, int]]:
        if len(self.words) <= self.FEW:
            return self.words
        half = (len(self.words[0][0]) - 1) // 2
        if self.halves is None:
            self.halves = {}
            for entry in self.words:
                self.halves.setdefault((True, entry[0][:half]), []).append(entry)
                self.halves.setdefault((False, entry[0][-half:]), []).append(entry)
        first = self.halves.get((True, word[:half]), [])
        return first + [e for e in self.halves.get((False, word[-half:]), []) if e[0][:half] != word[:half]]


def _spent(counts: bytes, other: bytes, level: int, left: int) -> int | None:
    """What is left of the budget when the path goes on as ``other``, None if it does not suffice."""
    if counts[level:] == other[level:]:
        return left
    if left == NOTHING:
        return None
    changes = [(b - a) & 255 for a, b in zip(counts[level:], other[level:]) if a != b]
    if left == DEFICIT:
        return NOTHING if changes == [255] else None
    return DEFICIT if changes == [1] else NOTHING if changes == [1, 255] else None


class Subtree:
    """The trie below an upper path.  Words are added in the order of their counts.

    A node is a range of paths until it is first met, then its children by the next count; a range of one path is not
    opened further.
    """

    def __init__(self) -> None:
        self.leaves: list[Leaf] = []
        self.root: dict | None = None

    def add(self, word: str, n: int, counts: bytes) -> None:
        if not self.leaves or self.leaves[-1].counts != counts:
            self.leaves.append(Leaf(counts))
        self.leaves[-1].words.append((word, n))

    def _opened(self, first: int, last: int, level: int) -> dict:
        """Children of the node of leaves ``first`` to ``last`` (exclusive), as ranges or single leaves."""
        children: dict[int, Leaf | tuple[int, int] | dict] = {}
        begin = first
        for i in range(first + 1, last + 1):
            if i == last or self.leaves[i].counts[level] != self.leaves[begin].counts[level]:
                children[self.leaves[begin].counts[level]] = self.leaves[begin] if i == begin + 1 else (begin, i)
                begin = i
        return children

    def search(self, word: str, budget: int, counts: bytes) -> Iterator[tuple[str, int]]:
        """Words at the ends of the paths within the budget, depth first, each verified."""
        if not self.leaves:
            return
        if self.root is None:
            self.root = self._opened(0, len(self.leaves), 0)
        stack = [(self.root, 0, budget)]
        while stack:
            node, level, left = stack.pop()
            count = counts[level]
            steps = ((count, left),)
            if left == BOTH:
                steps = ((count, BOTH), ((count + 1) & 255, DEFICIT))
            elif left == DEFICIT:
                steps = ((count, DEFICIT), ((count - 1) & 255, NOTHING))
            for step, rest in steps:
                child = node.get(step)
                if child is None:
                    continue
                if type(child) is tuple:
                    child = node[step] = self._opened(*child, level + 1)
                if type(child) is dict:
                    stack.append((child, level + 1, rest))
                elif (rest := _spent(counts, child.counts, level + 1, rest)) is not None:
                    for other, n in child.near(word):
                        # Words of the very same path meet from both sides.
                        if (rest != BOTH or word < other) and one_edit(word, other):
                            yield other, n


class Path:
    """The words of one path and half; those that share the first half are left to its own key."""

    def __init__(self, last: bool) -> None:
        self.last = last
        self.words: list[tuple[str, int]] = []

    def add(self, word: str, n: int, counts: bytes) -> None:
        self.words.append((word, n))

    def search(self, word: str, budget: int, counts: bytes) -> Iterator[tuple[str, int]]:
        for other, n in self.words:
            half = (len(other) - 1) // 2
            if self.last and word[:half] == other[:half]:
                continue
            if (budget != BOTH or word < other) and one_edit(word, other):
                yield other, n


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words, both ways; rows come by key, the words that lie there before those that look there."""
    held_key, held = None, None
    found: list[tuple[str, str, int]] = []
    for batch in batches:
        for word, n, budget, key, lower in zip(*(column.to_pylist() for column in batch.columns)):
            if key != held_key:
                held_key, held = key, Path(key[GROUPS:].startswith(b"last")) if len(key) > GROUPS else Subtree()
            if budget is None:
                held.add(word, n, lower)
                continue
            for other, m in held.search(word, budget, lower):
                found.append((word, other, m))
                found.append((other, word, n))
            if len(found) > 20_000:
                yield _arrow(found, "word near near_n")
                found = []
    if found:
        yield _arrow(found, "word near near_n")


def _levels_for(sizes: DataFrame, shard_words: int) -> int:
    """The least number of upper levels at which no path is crowded, or the most allowed."""
    level = F.explode(F.sequence(F.lit(1), F.lit(MOST_TOP))).alias("top")
    paths = sizes.select(level, "upper", "words").groupBy("top", F.expr("substring(upper, 1, top)")).agg(F.sum("words").alias("words"))
    largest = paths.groupBy("top").agg(F.max("words").alias("words")).filter(F.col("words") <= shard_words)
    return largest.agg(F.coalesce(F.min("top"), F.lit(MOST_TOP))).first()[0]


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word``, a word ``near`` it and that one's ``near_n``, for all pairs both ways; ``words`` holds each word once."""
    counted = written(words.select("word", "n").mapInArrow(_vectors, VECTOR), "spelling-vectors")
    sizes = counted.groupBy(F.expr(f"substring(counts, 1, {MOST_TOP})").alias("upper")).agg(F.count(F.lit(1)).alias("words"))
    sizes = written(sizes, "spelling-paths")
    top = _levels_for(sizes, shard_words)
    uppers = sizes.groupBy(F.expr(f"substring(upper, 1, {top})").alias("upper")).agg((F.sum("words") > shard_words).alias("crowded"))
    # Paths under which no word lies drop out here.
    routed = _placed(counted, top).join(written(uppers, "spelling-uppers"), "upper")
    if uppers.filter("crowded").isEmpty():
        keyed = routed.select("word", "n", "budget", F.col("upper").alias("key"), "lower")
    else:
        routed = written(routed, "spelling-routes")
        plain = routed.filter("NOT crowded").select("word", "n", "budget", F.col("upper").alias("key"), "lower")
        deep = routed.filter("crowded").select("word", "n", "budget", "upper", "lower")
        keyed = plain.unionAll(deep.mapInArrow(_descend, KEYED))
    ordered = keyed.repartition("key").sortWithinPartitions("key", F.col("budget").isNull().desc(), "lower")
    return ordered.mapInArrow(_search, "word string, near string, near_n long")


def _rooted(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of its chain, for words that have a form; chains double at each step."""
    roots = forms.select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        stepped = roots.join(further, "root", "left")
        stepped = stepped.select("word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("_moved"))
        stepped = written(stepped, "spelling-roots")
        roots = stepped.drop("_moved")
        if stepped.filter("_moved").isEmpty():
            break
    return roots


def group_variants(words: DataFrame, ratio: int = RATIO, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of each word of ``words`` (word, n).

    A word's form is its near word of largest ``n``, the smallest of several, if that is ``ratio`` times its own or
    more.  ``root`` is the last of the forms' forms, or the word itself.
    """
    best = near_words(words, shard_words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("_best")
    )
    found = words.select("word", "n").join(best, "word", "left")
    form_n = -F.col("_best.less")
    is_form = F.coalesce(form_n >= ratio * F.col("n"), F.lit(False))
    found = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("_best.near")).alias("form"),
        F.when(is_form, form_n).alias("form_n"),
    )
    found = written(found, "spelling-forms")
    roots = _rooted(found.filter("form IS NOT NULL"))
    rows = found.join(roots, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """:func:`group_variants` of the words of all texts."""

    def build() -> DataFrame:
        words = written(word_counts(docs), "spelling-words")
        return group_variants(words, shard_words=shard_words)

    return distilled(docs.sparkSession, "spelling", build)
