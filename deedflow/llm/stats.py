"""Statistics of whole texts: what the rules on quality look at."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from deedflow.llm.text import Words, hash_spans, mixed, windows, word_hashes, words_of

WINDOW = 5
SYMBOLS = b"#*$%&|<>"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rates that a model reads, and the sign that its score may change with: -1 falling, 0 free.
FEATURES = {
    "symbol_rate": -1,
    "dup_line_rate": -1,
    "repeat_rate": -1,
    "echo_rate": -1,
    "upper_rate": -1,
    "bang_rate": -1,
    "pipe_rate": -1,
    "digit_rate": 0,
    "mean_word": 0,
    "stop_rate": 0,
    "words_per_line": 0,
    "log_words": 0,
}


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _is_one_of(data: np.ndarray, characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table[data]


def line_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every \\n-split line that has a word."""
    breaks = np.flatnonzero(words.data == 10)
    rows, before = words.rows, np.searchsorted(breaks, words.starts)
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (before[1:] != before[:-1])
    rows, before = rows[new], before[new]
    edges = np.concatenate([[-1], breaks, [len(words.data)]])
    starts = np.maximum(edges[before] + 1, words.offsets[rows])
    ends = np.minimum(edges[before + 1], words.offsets[rows + 1])
    return hash_spans(words.data, starts, ends), rows


def _own(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hashes that differ between rows."""
    return mixed(hashes + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def repeated_words(words: Words, width: int = WINDOW) -> np.ndarray:
    """Marks the words in windows found twice or more in their text."""
    rows = words.rows
    hashes, at = windows(word_hashes(words), rows, width)
    keys = _own(hashes, rows[at])
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(rows) + 1, np.int64)
    edge[at[again]] += 1
    edge[at[again] + width] -= 1
    return np.cumsum(edge[:-1]) > 0


def statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """The base counts and the model's rates, a value per text."""
    words = words_of(column)
    data, offsets, counts = words.data, words.offsets, words.counts
    characters = (data & 0xC0) != 0x80
    in_word = np.zeros(len(data) + 1, np.int8)
    in_word[words.starts] = 1
    in_word[words.ends[words.ends < len(data)]] -= 1
    in_word = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)
    hashes, rows = line_hashes(words)
    n = len(counts)
    lines = np.bincount(rows, minlength=n)
    _, first = np.unique(_own(hashes, rows), return_index=True)
    base = {
        "n_words": counts,
        "word_chars": _per_row(characters & in_word, offsets),
        "n_symbols": _per_row(_is_one_of(data, SYMBOLS), offsets),
        "n_dup_lines": lines - np.bincount(rows[first], minlength=n),
        "n_repeat_words": np.bincount(words.rows[repeated_words(words)], minlength=n),
    }
    chars, many = np.maximum(base["word_chars"], 1), np.maximum(counts, 1)
    each, rows_of_words = word_hashes(words), words.rows
    echo = (each[1:] == each[:-1]) & (rows_of_words[1:] == rows_of_words[:-1])
    short = (words.ends - words.starts) <= 3
    rates = {
        "symbol_rate": base["n_symbols"] / chars,
        "dup_line_rate": base["n_dup_lines"] / np.maximum(lines, 1),
        "repeat_rate": base["n_repeat_words"] / many,
        "echo_rate": np.bincount(rows_of_words[1:][echo], minlength=n) / many,
        "upper_rate": _per_row((data >= 65) & (data <= 90), offsets) / chars,
        "bang_rate": _per_row(data == 33, offsets) / chars,
        "pipe_rate": _per_row(data == 124, offsets) / many,
        "digit_rate": _per_row((data >= 48) & (data <= 57), offsets) / chars,
        "mean_word": base["word_chars"] / many,
        "stop_rate": np.bincount(rows_of_words[short], minlength=n) / many,
        "words_per_line": np.log1p(counts / np.maximum(lines, 1)),
        "log_words": np.log1p(counts),
    }
    return {k: v.astype(np.int64) for k, v in base.items()} | {k: rates[k].astype(np.float64) for k in FEATURES}
