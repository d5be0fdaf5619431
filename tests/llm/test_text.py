import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from deedflow.llm.text import hash_spans, pieces, windows, word_hashes, words_of

TEXTS = st.lists(st.none() | st.text(alphabet="aAbéß\U0001f600 \n\t\x0b\x1c .", max_size=30), max_size=8)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(deadline=None)
@given(TEXTS)
def test_words(texts):
    words = words_of(pa.array(texts, pa.string()))
    found = [words.word(i).decode() for i in range(len(words.starts))]
    assert found == [w for t in texts for w in split(t)]
    assert words.counts.tolist() == [len(split(t)) for t in texts]


@settings(deadline=None)
@given(TEXTS)
def test_equal_words_have_equal_hashes(texts):
    words = words_of(pa.array(texts, pa.large_string()), lower=True)
    hashes = word_hashes(words)
    found = [words.word(i) for i in range(len(hashes))]
    assert len(set(found)) == len(set(zip(found, hashes.tolist(), strict=True))) == len(set(hashes.tolist()))


@settings(deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_windows(texts, width):
    words = words_of(pa.array(texts, pa.string()))
    hashes, at = windows(word_hashes(words), words.rows, width)
    expected = [tuple(w[i : i + width]) for w in map(split, texts) for i in range(len(w) - width + 1)]
    assert len(hashes) == len(expected)
    assert len(set(hashes.tolist())) == len(set(expected))
    assert [words.word(i).decode() for i in at] == [e[0] for e in expected]


def test_a_hash_does_not_depend_on_its_place():
    data = np.frombuffer(b"word" * 100_000, np.uint8)
    starts = np.arange(0, len(data), 4)
    assert len(set(hash_spans(data, starts, starts + 4).tolist())) == 1
    assert len(hash_spans(data, np.array([0]), np.array([400_000]))) == 1


@pytest.mark.parametrize("most", [1, 5, 1000])
def test_pieces_hold_every_row(most):
    batch = pa.RecordBatch.from_pydict({"text": ["abc", None, "", "d" * 50, "e"]}).slice(1)
    found = [t for p in pieces(batch, most=most) for t in p.column("text").to_pylist()]
    assert found == [None, "", "d" * 50, "e"]


def thue_morse(n):
    """A string of a and b and its complement, which sums of powers of any odd base take for the same from n = 1024 on."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [8, 16, 64, 256, 264, 1024, 4096])
def test_patterned_spans_differ(n):
    pair = thue_morse(n)
    data = np.frombuffer("".join(pair).encode(), np.uint8)
    hashes = hash_spans(data, np.array([0, n]), np.array([n, 2 * n]))
    assert hashes[0] != hashes[1]


def test_hashes_depend_on_the_bytes_of_the_span_only():
    r = random.Random(9)
    spans = [bytes(r.randrange(256) for _ in range(n)) for n in (0, 1, 7, 8, 9, 15, 16, 17, 255, 256, 257, 300, 5000) for _ in range(3)]
    spans += [b"a", b"a\0", b"\0" * 8, b"\0" * 16, b""]
    seen = {}
    for _ in range(4):
        r.shuffle(spans)
        data = np.frombuffer(b"".join(s + b"x" * r.randrange(9) for s in spans) + b"end", np.uint8)
        text, starts = data.tobytes(), []
        at = 0
        for s in spans:
            at = text.index(s, at)
            starts.append(at)
            at += len(s)
        starts = np.array(starts)
        for s, h in zip(spans, hash_spans(data, starts, starts + [len(s) for s in spans])):
            assert seen.setdefault(s, h) == h
    assert len(set(seen.values())) == len(seen)
