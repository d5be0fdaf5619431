"""Token counts of whole texts by a byte-level BPE vocabulary, looked up in two tiers inside the tasks.

Merges never cross a pre-token, so a text's count is the sum of its pre-tokens' lengths.  The lengths of the most
frequent pre-tokens are a small table that every worker gets; the others are encoded by the tokenizer and kept in the
worker.  No pre-token is shuffled: what tasks send is a bounded summary of their most frequent ones, and it decides
only what is looked up where, never a count.

Null texts count as empty, and empty texts have no tokens.  Repeated rows and ids are counted each, and other columns
are left alone.  An empty table gives an empty result.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice
from types import ModuleType

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# Fixed value: how byte-level vocabularies of this kind split a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

# So many lengths are sent to every worker, chosen from so many pre-tokens of each task.
FREQUENT = 1 << 16
PER_TASK = 1 << 12
# A task's counters are cut to half of this when they outgrow it.
COUNTED = 1 << 19
# So many lengths of other pre-tokens a worker keeps, in two generations.
CACHED = 1 << 18
# Longer pre-tokens are in neither table.
LONGEST = 64
# Pre-tokens of a text that are looked at together.
STEP = 1 << 17


class Splitter:
    """Splits texts as the tokenizer does, and tells the texts in which it might not.

    The character classes of two libraries may be of different Unicode versions, so each character is tried out with
    the tokenizer when it is first met.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.own = tokenizer.pre_tokenizer.pre_tokenize_str
        self.find = regex.compile(PATTERN)
        self.special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        self.known: set[str] = set()
        self.odd: set[str] = set()
        self._try_out(map(chr, range(128)))
        self.odd_ascii = frozenset(self.odd)

    def _try_out(self, characters: Iterable[str]) -> None:
        for c in characters:
            probe = f"a{c}a 1{c}1 !{c}! {c}{c} \n{c}\n {c}a  {c}"
            theirs = [probe[start:end] for _, (start, end) in self.own(probe)]
            (self.known if theirs == self.find.findall(probe) else self.odd).add(c)

    def splits(self, text: str) -> bool:
        """Whether :meth:`pieces` splits this text as the tokenizer does."""
        if any(token in text for token in self.special):
            return False
        if text.isascii():
            return not self.odd_ascii or self.odd_ascii.isdisjoint(text)
        new = set(text) - self.known
        if new:
            self._try_out(new - self.odd)
        return new.isdisjoint(self.odd)

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text, in lists of bounded length."""
        if len(text) <= STEP:
            yield self.find.findall(text)
            return
        found = (match.group() for match in self.find.finditer(text))
        while some := list(islice(found, STEP)):
            yield some


class Lengths:
    """Numbers of tokens: a table of frequent pre-tokens first, then those that this worker has met."""

    def __init__(self, definition: str, frequent: dict[str, int]):
        self.tokenizer = opened(definition)
        self.splitter = Splitter(self.tokenizer)
        self.frequent = frequent
        self.new: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def encoded(self, pieces: list[str]) -> list[int]:
        return [len(found) for found in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _rare(self, pieces: list[str]) -> int:
        total, missing = 0, Counter()
        for piece in pieces:
            length = self.new.get(piece)
            if length is None:
                length = self.old.get(piece)
                if length is None:
                    missing[piece] += 1
                    continue
                self.new[piece] = length
            total += length
        if missing:
            for (piece, copies), length in zip(missing.items(), self.encoded(list(missing))):
                total += copies * length
                if len(piece) <= LONGEST:
                    self.new[piece] = length
        if len(self.new) > CACHED // 2:
            self.old, self.new = self.new, {}
        return total

    def count(self, text: str) -> int:
        if not self.splitter.splits(text):
            return self.encoded([text])[0]
        total = 0
        for pieces in self.splitter.pieces(text):
            lengths = list(map(self.frequent.get, pieces))
            total += sum(filter(None, lengths))
            if None in lengths:
                total += self._rare([piece for piece, length in zip(pieces, lengths) if length is None])
        return total


def opened(definition: str) -> Tokenizer:
    """The tokenizer of a definition, with texts whole and of their own length."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    kind = repr(tokenizer.pre_tokenizer)
    if tokenizer.normalizer is not None or "ByteLevel" not in kind or "add_prefix_space=True" in kind:
        raise ValueError("only byte-level vocabularies without a normalizer or an added first space split like this")
    return tokenizer


def _splitter(definition: str) -> Splitter:
    kept = _worker()
    if kept.get("definition") != definition:
        kept["definition"], kept["splitter"] = definition, Splitter(opened(definition))
    return kept["splitter"]


def _texts(batches: Iterable[pa.RecordBatch], column: int = 0) -> Iterator[str]:
    for batch in batches:
        for value in batch.column(column):
            yield value.as_py() or ""


def frequent_pieces(docs: DataFrame, definition: Broadcast, most: int = FREQUENT, per_task: int = PER_TASK) -> list[str]:
    """The most frequent pre-tokens of all texts, ``most`` at most; each task names ``per_task`` of its own."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, seen = _splitter(definition.value), Counter()
        for text in _texts(batches):
            if splitter.splits(text):
                for pieces in splitter.pieces(text):
                    seen.update(pieces)
                    if len(seen) > COUNTED:
                        seen = Counter(dict(seen.most_common(COUNTED // 2)))
        top = [(piece, n) for piece, n in seen.most_common(per_task) if n > 1 and len(piece) <= LONGEST]
        yield pa.RecordBatch.from_pydict(
            {"piece": pa.array([piece for piece, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())}
        )

    named = docs.select("text").mapInArrow(summarise, "piece string, n long")
    named = named.groupBy("piece").agg(F.sum("n").alias("n"))
    return [row.piece for row in named.orderBy(F.desc("n"), "piece").limit(most).select("piece").collect()]


def _worker() -> dict:
    """What lasts as long as the worker does; this package's own variables are sent anew with each task."""
    return sys.modules.setdefault("token_counts_worker", ModuleType("token_counts_worker")).__dict__


def _lengths(key: str, definition: Broadcast, frequent: Broadcast) -> Lengths:
    kept = _worker()
    if kept.get("key") != key:
        kept["key"], kept["lengths"] = key, Lengths(definition.value, frequent.value)
    return kept["lengths"]


def frequent_lengths(docs: DataFrame, definition: str, most: int = FREQUENT) -> dict[str, int]:
    """The table that every worker gets: ``most`` pre-tokens at most, none longer than ``LONGEST``."""
    sent = docs.sparkSession.sparkContext.broadcast(definition)
    pieces = frequent_pieces(docs, sent, most)
    return dict(zip(pieces, Lengths(definition, {}).encoded(pieces)))


def count_tokens(docs: DataFrame, path: str, limit: int = 512, most: int = FREQUENT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every text, by the vocabulary in the file ``path``.

    Only the driver needs the file.  Strings of special tokens inside a text are treated as the tokenizer does by
    default, no token is added, and nothing is cut off.
    """
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    context = docs.sparkSession.sparkContext
    frequent = context.broadcast(frequent_lengths(docs, definition, most))
    sent, key = context.broadcast(definition), uuid.uuid4().hex
    kind = docs.schema["doc_id"].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _lengths(key, sent, frequent)
        for batch in batches:
            counts = [lengths.count(text) for text in _texts([batch], 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    rows = docs.select("doc_id", "text", n_bytes).mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
