"""Passages, near copies, lines and benchmark overlaps against brute force on small and edge-case rows."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from deedflow.llm import decontaminate, line_dedup, near_dedup, substring_dedup
from deedflow.llm.stats import statistics
from tests.llm.edge_rows import CLASHING, ROWS, documents, edge_documents

LAST = (1 << 63) - 1


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def order(doc_id):
    return LAST if doc_id is None else doc_id


def random_documents(seed, n=60, hot=True):
    """Texts put together from few sentences, so that all kinds of overlap come up; a third are copies."""
    r = random.Random(seed)
    sentences = [" ".join(f"w{r.randrange(40)}" for _ in range(r.randrange(6, 30))) for _ in range(12)]
    out = []
    for i in range(n):
        parts = [r.choice(sentences) for _ in range(r.randrange(1, 5))]
        text = r.choice(["\n", " ", "  "]).join(parts).split(" ")
        for _ in range(r.randrange(3)):
            text[r.randrange(len(text))] = f"w{r.randrange(60)}"
        out.append((i * 3 % n, out[0][1] if hot and out and i % 3 == 0 else " ".join(text)))
    return out


def brute_substrings(rows):
    first = {}
    for doc_id, text in rows:
        w = words(text)
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            first[key] = min(first.get(key, LAST), order(doc_id))
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = {j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < order(doc_id) for j in range(i, i + 13)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [random_documents(1), random_documents(2, hot=False), ROWS])
def test_substrings(spark, rows):
    docs = edge_documents(spark) if rows is ROWS else documents(spark, rows)
    found = substring_dedup.without_repeats(docs).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_substrings(rows)


def test_substrings_of_nothing(spark):
    assert substring_dedup.without_repeats(edge_documents(spark).limit(0)).count() == 0


def test_wrong_hits_stay(spark, monkeypatch):
    """Spans that do not hold against the words at their first place are not removed."""
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(40))) for i in range(5)]
    docs = documents(spark, rows)
    numbers = substring_dedup.written(substring_dedup.numbered(docs), "numbers")
    forged = spark.createDataFrame([(3, 2, 15, 0, 4), (4, 0, 20, 1, 1)], "num long, start long, length long, source long, source_start long")
    monkeypatch.setattr(substring_dedup, "numbered", lambda _: numbers)
    monkeypatch.setattr(substring_dedup, "spans_of", lambda *_: forged)
    assert {r.n_removed for r in substring_dedup.without_repeats(docs).collect()} == {0}


def test_windows_of_equal_hash(spark, monkeypatch):
    """With hashes of few values, different windows are told apart by their words, and no removal is lost."""
    real = substring_dedup.windows

    def coarse(hashes, rows, width):
        out, at = real(hashes, rows, width)
        return out % np.uint64(50), at

    monkeypatch.setattr(substring_dedup, "windows", coarse)
    rows = random_documents(7, 40)
    found = substring_dedup.without_repeats(documents(spark, rows)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_substrings(rows)


def brute_paths(rows):
    """Lengths of the maximal nonbranching paths of windows that a larger id has too, by first place."""
    places = {}
    for num, (_, text) in enumerate(sorted(rows)):
        w = words(text)
        for i in range(len(w) - 12):
            places.setdefault(tuple(w[i : i + 13]), []).append((num, i))
    repeated = {e: p for e, p in places.items() if p[0][0] < p[-1][0]}
    at = {p[0]: e for e, p in repeated.items()}
    ahead = {}
    for e, p in repeated.items():
        after = at.get((p[0][0], p[0][1] + 1))
        if after and [(d, i + 1) for d, i in p] == repeated[after]:
            ahead[e] = after
    out = {}
    for e in set(repeated) - set(ahead.values()):
        n, x = 1, e
        while x in ahead:
            n, x = n + 1, ahead[x]
        out[repeated[e][0]] = n
    return out


@pytest.mark.parametrize("seed", [1, 5])
def test_compacted_paths(spark, seed):
    rows = random_documents(seed, 40, hot=False)
    long = " ".join(f"x{i}" for i in range(300))
    rows += [(100, long), (101, "a " + long), (102, long + " b c"), (103, " ".join(long.split()[100:250]) + " d")]
    rows += [(104, "1 " * 90), (105, "1 " * 70)]
    docs = documents(spark, rows)
    numbers = substring_dedup.written(substring_dedup.numbered(docs), "numbers")
    edges = substring_dedup.written(substring_dedup._edges(docs, numbers), "edges")
    found = substring_dedup.compacted(substring_dedup.written(substring_dedup.repeated_edges(edges), "repeated")).collect()
    bits = substring_dedup.PLACE_BITS
    assert {(r.first >> bits, r.first & ((1 << bits) - 1)): r.length for r in found} == brute_paths(rows)
    assert sum(r.length == 150 - 12 for r in found) == 1


def shingle_set(text):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set()


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= 80 * len(sets[i] | sets[j]):
            parent[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), LAST), order(doc_id))
    rows = Counter((d, len(sets[i]), None if least[top(i)] == LAST else least[top(i)]) for i, (d, _) in enumerate(rows))
    return rows, sorted(least.values())


def near_documents(seed, n=80):
    """Chains of edits, so that components hold pairs below the threshold, and many nearly linked ones."""
    r = random.Random(seed)
    base = [f"v{r.randrange(500)}" for _ in range(60)]
    out = []
    for i in range(n):
        text = list(base)
        for _ in range(r.randrange(7)):
            text[r.randrange(len(text))] = f"v{r.randrange(500)}"
        if r.random() < 0.2:
            base = text
        out.append((n - i, " ".join(text[: r.choice([60, 58, 55])])))
    return out


@pytest.mark.parametrize("rows", [near_documents(1), near_documents(3, 150), random_documents(4), ROWS])
def test_near_duplicates(spark, rows):
    docs = edge_documents(spark) if rows is ROWS else documents(spark, rows)
    expected, least = brute_components(rows)
    found = near_dedup.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == expected
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(order(r.doc_id) for r in kept.collect()) == least
    if len({doc_id for doc_id, _ in rows}) == len(rows):
        assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(edge_documents(spark).limit(0)).count() == 0
    assert near_dedup.keep_one(edge_documents(spark).limit(0)).count() == 0


def test_signatures_estimate_similarity():
    r = np.random.default_rng(5)
    errors = []
    for size in (3, 20, 300, 2000):
        for share in (0.3, 0.8):
            common = int(size * share)
            one, two = (np.concatenate([np.arange(common), r.integers(1 << 40, 1 << 62, size - common)]) for _ in range(2))
            elements = near_dedup.mixed(np.concatenate([one, two]).astype(np.uint64))
            found = near_dedup.super_min_hash(elements, np.repeat([0, 1], size), 2)
            errors.append(abs((found[0] == found[1]).mean() - common / (2 * size - common)))
            assert (found[0] != near_dedup._MAX).all()
            # Every set's slots are ranks of a permutation's steps: the same alone as among others.
            alone = near_dedup.super_min_hash(elements[:size].copy(), np.zeros(size, np.int64), 1)
            assert (alone[0] == found[0]).all()
    assert max(errors) < 0.15


def test_components_of_long_chains(spark):
    names = [bytes([i // 256, i % 256]) for i in range(400)]
    shuffled = random.Random(3).sample(names, 400)
    links = list(zip(shuffled[:250], shuffled[1:250], strict=False)) + [(shuffled[300], x) for x in shuffled[301:]]
    frame = spark.createDataFrame(links, "a binary, b binary").repartition(7)
    found = {bytes(r.node): bytes(r.root) for r in near_dedup.components(frame).collect()}
    assert {x: min(shuffled[:250]) for x in shuffled[:250] if x != min(shuffled[:250])}.items() <= found.items()
    assert {x: min(shuffled[300:]) for x in shuffled[300:] if x != min(shuffled[300:])}.items() <= found.items()
    assert len(found) == 249 + 99


def brute_lines(rows):
    def chunks(text):
        lines = text.split("\n") if text else []
        hashes = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
        start = 0
        for i in range(len(lines)):
            rolled = sum(hashes[i - j] * f for j, f in enumerate(line_dedup.FACTORS) if i >= j)
            if rolled // 8 % line_dedup.SHARE == 0 or i == len(lines) - 1:
                yield start, lines[start : i + 1]
                start = i + 1

    seen, out = {}, []
    for doc_id, text in sorted(rows, key=lambda r: order(r[0])):
        kept, n = [], 0
        for start, lines in chunks(text or ""):
            n += len(lines)
            chunk = "\n".join(lines)
            if len(lines) < 2 or not words(chunk):
                kept += lines
            elif seen.setdefault(chunk, (doc_id, start)) == (doc_id, start):
                kept += lines
        out.append((doc_id, n, n - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def line_documents(seed):
    r = random.Random(seed)
    blocks = [[f"line {r.randrange(1000)}" for _ in range(r.randrange(4, 30))] for _ in range(6)]
    rows = []
    for i in range(50):
        lines = [x for _ in range(r.randrange(1, 4)) for x in r.choice(blocks)]
        if r.random() < 0.5:
            lines.insert(r.randrange(len(lines)), r.choice(["", "  ", f"own {i}"]))
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("rows", [line_documents(1), line_documents(2), [r for r in ROWS if r[0] not in (None, 1, 6)]])
def test_line_chunks(spark, rows):
    found = line_dedup.without_repeated_chunks(documents(spark, rows, id="x", _lines="x")).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_lines(rows)
    assert sum(r.n_removed for r in found) > 0


def test_line_chunks_of_edge_rows(spark):
    docs = edge_documents(spark)
    found = line_dedup.without_repeated_chunks(docs).collect()
    assert len(found) == docs.count()
    assert line_dedup.without_repeated_chunks(docs.limit(0)).count() == 0


def test_masks_miss_no_stretch():
    for n in range(decontaminate.SPAN, decontaminate.STRETCH + 1):
        for changed in itertools.combinations(range(n), n - -(-n * 4 // 5)):
            assert any(
                all(at + place not in changed for place in mask)
                for at in range(n - decontaminate.SPAN + 1)
                for mask in decontaminate.MASKS
            )


def brute_overlaps(docs, items):
    low = lambda t: words(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    out = []
    for doc_id, text in docs:
        w = low(text)
        for item_id, item in items:
            t, best = low(item), (0, 0)
            if len(t) < decontaminate.LEAST_WORDS:
                continue
            need = min(16, len(t))
            for shift in range(-len(t) + 1, len(w)):
                equal = [w[j + shift] == t[j] for j in range(max(0, -shift), min(len(t), len(w) - shift))]
                for i in range(len(equal) - need + 1):
                    most = sum(equal[i : i + need])
                    if most * 5 >= need * 4 and (len(t) >= decontaminate.SPAN or most == need):
                        best = max(best, (most, sum(equal)))
            if best[0]:
                out.append((doc_id, item_id, *best))
    return Counter(out)


def overlap_tables(seed):
    r = random.Random(seed)
    items = [(i, " ".join(f"w{r.randrange(30)}" for _ in range(n))) for i, n in enumerate([3, 8, 11, 12, 14, 15, 16, 20, 40, 40])]
    docs = []
    for i in range(60):
        passage = words(r.choice(items)[1])
        passage = passage[r.randrange(1 + len(passage) // 3) :][: r.choice([10, 16, 50])]
        for _ in range(r.randrange(5)):
            passage[r.randrange(len(passage))] = f"W{r.randrange(30)}"
        filler = lambda: [f"F{r.randrange(30)}" for _ in range(r.randrange(9))]
        docs.append((i, " ".join(filler() + passage + filler() + (words(items[8][1]) if i % 3 == 0 else []))))
    return docs, [*items, (None, "a b c d e f g h"), (20, None), (21, "")]


@pytest.mark.parametrize("block", [250_000, 30])
def test_overlaps(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    rows, items = overlap_tables(1)
    rows += [(1000 + i, text) for i, (_, text) in enumerate(ROWS[3:8])]
    docs = documents(spark, rows, item_id="x")
    items_frame = spark.createDataFrame(items, "item_id long, text string")
    expected = brute_overlaps(rows, items)
    assert Counter(tuple(r) for r in decontaminate.find_overlaps(docs, items_frame).collect()) == expected
    clean = decontaminate.without_overlaps(docs, items_frame)
    assert clean.columns == docs.columns
    dirty = {d for d, *_ in expected}
    assert Counter(r.doc_id for r in clean.collect()) == Counter(d for d, _ in rows if d not in dirty)


def test_overlaps_of_nothing(spark):
    docs, none = edge_documents(spark), spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame([(1, ROWS[0][1])], "item_id long, text string")
    assert decontaminate.find_overlaps(docs, none).count() == 0
    assert decontaminate.without_overlaps(docs, none).count() == len(ROWS)
    assert decontaminate.find_overlaps(docs.limit(0), items).count() == 0
    # The copies, and the null id's copy.
    assert Counter(r.doc_id for r in decontaminate.find_overlaps(docs, items).collect()) == Counter([0, 1, 1, 2, None])


def test_plain_words():
    found = substring_dedup.words_of(pa.array(["  a  bc\n", None, "d", ""]))
    plain = substring_dedup.Plain(found)
    assert [plain.text(a, b) for a, b in zip(plain.bounds, plain.bounds[1:], strict=False)] == [b"a bc", b"", b"d", b""]


def test_patterned_words_are_told_apart(spark):
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    a, b = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    linked = near_dedup.near_duplicates(documents(spark, [(0, f"p q r s {a}"), (1, f"p q r s {b}")])).collect()
    assert {r.doc_id: r.component_id for r in linked} == {0: 0, 1: 1}
    twelve = " ".join(f"w{i}" for i in range(12))
    rows = [(0, f"{a} {twelve}"), (1, f"{b} {twelve}"), (2, f"x {b} {twelve} y")]
    found = {r.doc_id: r.n_removed for r in substring_dedup.without_repeats(documents(spark, rows)).collect()}
    assert found == {0: 0, 1: 0, 2: 13}
    assert statistics(pa.array([f"{a}\n{b}\n{a}"]))["n_dup_lines"].tolist() == [1]
