"""Words and word hashes of whole Arrow text columns, without a Python object per word.

A word is a maximal run of bytes other than space and 0x09 to 0x0D, which in UTF-8 is the same as
``[^\\x20\\x09-\\x0D]+`` on characters.  Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE, _ROLL, _LANE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_BLOCK = 1 << 17
# Spans of more bytes are hashed one by one.
_LONG = 256
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
# Texts are worked on in pieces of about this many bytes (one text at least).
PIECE_BYTES = 2 << 20


@dataclass
class Words:
    """``bounds[i]:bounds[i + 1]`` are the words of text ``i``; ``offsets`` its bytes."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def pieces(batch: pa.RecordBatch, column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``most`` bytes of ``column``, each of one row at least."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(total, total[at] + most, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, one text after the other, and where each begins."""
    column = pc.fill_null(column, "")
    if pa.types.is_string(column.type):
        kind = np.int32
    else:
        column, kind = column.cast(pa.large_string()), np.int64
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(column: pa.Array, lower: bool = False) -> Words:
    data, offsets = column_bytes(column)
    if lower:
        data = _LOWER[data]
    solid = ~SPACE[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    before[edges] = False
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit (the finaliser of splitmix64), in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _lane_keys(first: int, last: int) -> np.ndarray:
    """What the lanes ``first`` to ``last`` (exclusive) of a span are keyed with."""
    return mixed(np.arange(first + 1, last + 1, dtype=np.uint64) * np.uint64(_LANE))


def _long_hash(span: np.ndarray) -> np.uint64:
    """Sum over the lanes of one span of any length, a block at a time."""
    total = np.uint64(0)
    for at in range(0, len(span), 8 * _BLOCK):
        part = span[at : at + 8 * _BLOCK]
        lanes = np.zeros(-(-len(part) // 8), "<u8")
        lanes.view(np.uint8)[: len(part)] = part
        lanes ^= _lane_keys(at // 8, at // 8 + len(lanes))
        total += mixed(lanes).sum(dtype=np.uint64)
    return total


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[starts[i]:ends[i]]``.

    A span's bytes are taken in lanes of eight; each is keyed by its place, mixed, and only then added to the others, so
    that no pattern of the text makes two spans' sums equal, as it does with sums of powers.
    """
    sizes = (ends - starts).astype(np.int64)
    total = np.zeros(len(starts), np.uint64)
    for i in np.flatnonzero(sizes > _LONG):
        total[i] = _long_hash(data[starts[i] : ends[i]])
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    # The eight bytes from each place on, of which those beyond the span are masked out.
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    active = np.flatnonzero((sizes > 0) & (sizes <= _LONG))
    for lane in range(_LONG // 8):
        if not len(active):
            break
        left = sizes[active] - 8 * lane
        lanes = eight[starts[active] + 8 * lane] & _MASKS[np.minimum(left, 8)]
        lanes ^= _lane_keys(lane, lane + 1)
        total[active] += mixed(lanes)
        active = active[left > 8]
    total += sizes.astype(np.uint64) * np.uint64(_BASE)
    return mixed(total)


def word_hashes(words: Words) -> np.ndarray:
    return hash_spans(words.data, words.starts, words.ends)


def windows(hashes: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each ``width`` consecutive words of one text, and the number of its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = hashes[:n].copy()
    for j in range(1, width):
        total *= np.uint64(_ROLL)
        total += hashes[j : j + n]
    at = np.flatnonzero(rows[:n] == rows[width - 1 :])
    return mixed(total[at]), at
