"""Token counts, repaired conversations and spelling variants against the library and brute force."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from deedflow.llm import conversation_repair, spelling, token_counts
from deedflow.llm.text import column_bytes
from tests.llm.edge_rows import CLASHING, ROWS, documents, edge_documents

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "a<|endoftext|>b <|endoftext|>",
    "<|endoftext|><|endoftext|>",
    "it's I'LL we'll ''s 'S   x\n\n\t y",
    "  　 x\u0085\x1c\x1d z ",
    "՘ new letters ࢏ \U0001e5d0 and \U00016d40",
    "é ‍ ﻿ \U0001f468‍\U0001f469 ٣٤ Ⅸ",
    "z" * 3_000 + " " * 3_000 + "." * 3_000,
    "word " * 150_000,
]


def test_token_counts_are_those_of_the_library(spark):
    library = Tokenizer.from_file(VOCABULARY)
    docs = edge_documents(spark).unionByName(
        documents(spark, [(100 + i, t) for i, t in enumerate(TEXTS)]), allowMissingColumns=True
    )
    texts = [text or "" for _, text in ROWS] + TEXTS
    ids = [i for i, _ in ROWS] + [100 + i for i in range(len(TEXTS))]
    wanted = []
    for i, text in zip(ids, texts):
        n = len(library.encode(text, add_special_tokens=False).ids)
        wanted.append((i, len(text.encode()), n, n > 512))
    for most in (1 << 16, 3):
        found = token_counts.count_tokens(docs, VOCABULARY, most=most).collect()
        assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)


def test_worker_caches_stay_small_and_right(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED", 8)
    monkeypatch.setattr(token_counts, "STEP", 16)
    definition = open(VOCABULARY, encoding="utf-8").read()
    lengths, library = token_counts.Lengths(definition, {"a": 1, " of": 1}), Tokenizer.from_file(VOCABULARY)
    r = random.Random(3)
    for _ in range(200):
        text = " ".join(r.choice(["of", "unbelievable", "Zürich", "naïve", "12345", "\n", "x" * 70]) for _ in range(30))
        assert lengths.count(text) == len(library.encode(text, add_special_tokens=False).ids)
        assert max(len(lengths.new), len(lengths.old)) <= 16
        assert max(map(len, [*lengths.new, *lengths.old, ""])) <= token_counts.LONGEST


def test_frequent_pieces_come_from_all_texts(spark):
    docs = documents(spark, [(i, "common words " * 5 + f"rare{i}") for i in range(300)])
    definition = open(VOCABULARY, encoding="utf-8").read()
    table = token_counts.frequent_lengths(docs, definition, most=3)
    assert set(table) == {" words", " common", " rare"}
    assert token_counts.count_tokens(docs.limit(0), VOCABULARY).collect() == []


def test_other_kinds_of_vocabularies_are_refused():
    for name in ("word_bpe_49k.json",):
        with pytest.raises(ValueError):
            token_counts.opened(open(public_tokenizers.path(name), encoding="utf-8").read())


# Conversations.


def cheapest(messages, begin=0, ends=(0, 3)):
    """The least of all edits by (cost, audit): a shortest path over places and states."""
    heap, done = [(0, "", 0, begin)], {}
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done[i, state] = (cost, audit)
        due, then = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}[state]
        heapq.heappush(heap, (cost + 2, audit + "I", i, then))
        if i < len(messages):
            initial, fault = messages[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state))
            if fault < 2:
                heapq.heappush(heap, (cost + 2 + fault, audit + "R", i + 1, then))
                if initial == due:
                    heapq.heappush(heap, (cost + fault, audit + "K", i + 1, then))
                if initial == "s" and state == 0:
                    heapq.heappush(heap, (cost + fault, audit + "K", i + 1, 1))
    return min((done[len(messages), end] for end in ends if (len(messages), end) in done), default=None)


def test_branch_and_bound_finds_the_least_audit():
    r = random.Random(1)
    for _ in range(5_000):
        messages = [(r.choice(["s", "u", "a", "x", ""]), r.choice([0, 0, 1, 2])) for _ in range(r.randrange(9))]
        begin, ends = r.randrange(4), r.choice([(0, 3), (0,), (1,), (2,), (3,)])
        assert conversation_repair.cheapest(messages, begin, ends) == cheapest(messages, begin, ends)


@pytest.mark.parametrize("roles", ["u", "a", "s", "us", "usa", "uua", "x"])
def test_branch_and_bound_prunes(roles):
    r = random.Random(2)
    messages = [(r.choice(roles), r.choice([0, 0, 1, 2])) for _ in range(3_000)]
    seen = []

    class Counted(list):
        def __getitem__(self, i):
            seen.append(i)
            return super().__getitem__(i)

    assert conversation_repair.cheapest(Counted(messages)) == cheapest(messages)
    assert len(seen) < 60 * len(messages)


def brute_repair(rows):
    """Report and repaired lines by conversation; ``rows`` are (conv_id, turn, role, text)."""
    grouped = defaultdict(list)
    for conv_id, turn, role, text in rows:
        grouped[conv_id].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv_id, group in grouped.items():
        group.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1], m[2]))
        faults, seen, counts = [], set(), Counter()
        for _, role, text in group:
            said = re.findall(r"[^\x20\x09-\x0D]", text)
            kind = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "fine"
            seen.add((role, text))
            counts[kind] += 1
            faults.append((role[:1], {"fine": 0, "truncated": 1}.get(kind, 2)))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(faults, faults[1:]))
        turns = {m[0] for m in group} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = cheapest(faults)
        lines, at = [], 0
        for edit in audit:
            due = "assistant" if lines and lines[-1][0] == "u" else "user"
            if edit == "I":
                lines.append(f"{due}:")
                continue
            _, role, text = group[at]
            at += 1
            if edit != "D":
                lines.append(f"{role if edit == 'K' else due}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv_id] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)
    return out


def random_turns(seed, n=400):
    """A third of the messages are of one conversation, another part of the null one; texts repeat."""
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        conv_id = r.choice([7, 7, None, *range(10, 30)]) if r.random() < 0.9 else r.randrange(1_000)
        turn = None if r.random() < 0.1 else r.randrange(12 if conv_id != 7 else 200)
        role = r.choice(["user", "assistant", "system", "user", "assistant", "unknown", "", None])
        text = r.choice(["Yes.", "No!", "cut", "", " \n", None, "é ", "a." * 40 + "b", "a." * 40 + "c", f"{r.random()}."])
        rows.append((conv_id, turn, role, text))
    return rows


def turns_frame(spark, rows, clash=True):
    fields = [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType())]
    fields += [T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    frame = spark.createDataFrame(rows, T.StructType(fields))
    return frame.withColumns({c: F.lit("clash") for c in (*CLASHING, "block", "turns", "keys", "audit", "cost")}) if clash else frame


@pytest.mark.parametrize("block_rows", [1, 3, 1024])
def test_repair(spark, block_rows):
    rows = random_turns(block_rows)
    found = conversation_repair.repair(turns_frame(spark, rows), block_rows)
    digests = {r.conv_id: r.repaired_sha256 for r in conversation_repair.digests(found.messages).collect()}
    got = {r.conv_id: (*[r[c] for c in conversation_repair.COUNTS], r.audit, digests[r.conv_id]) for r in found.reports.collect()}
    assert got == brute_repair(rows)


def test_no_block_outgrows_its_bound(spark):
    rows = [(1, i, "user", f"Line {i}.") for i in range(2_000)] + [(2, None, "user", "same")] * 500
    found = conversation_repair.repair(turns_frame(spark, rows), 64)
    most = found.messages.agg(F.max(F.size("messages"))).first()[0]
    assert most <= 64 * 2 + 4
    audits = {r.conv_id: (r.cost, r.audit, r.duplicate) for r in found.reports.collect()}
    assert audits[1] == (2_000, "KR" * 1_000, 0)
    assert audits[2][2] == 499
    assert audits[2][1] == cheapest([("u", 1)] + [("u", 2)] * 499)[1]


def test_repair_of_nothing(spark):
    found = conversation_repair.repair(turns_frame(spark, [], clash=False))
    assert found.reports.collect() == [] and conversation_repair.digests(found.messages).collect() == []


def test_damage(spark):
    rows = [(c, t, "assistant", "A. b! c?") for c in (None, 1, 2) for t in (None, *range(60))]
    found = Counter((r.conv_id, r.turn, r.role, r.text) for r in conversation_repair.damaged(turns_frame(spark, rows)).collect())
    wanted = Counter()
    for c, t, role, text in rows:
        key = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = {1: "", 2: "A b c"}.get(key, text)
        wanted[c, t, "user" if key == 4 else role, text] += {0: 0, 3: 2}.get(key, 1)
    assert found == +wanted


# Words.


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= 2}


def brute_variants(n):
    alike, near = defaultdict(set), defaultdict(set)
    for word in n:
        for i in range(len(word)):
            rest = word[:i] + word[i + 1 :]
            alike[i, rest].add(word)
            if rest in n:
                near[word].add(rest)
                near[rest].add(word)
    for group in alike.values():
        for word in group:
            near[word] |= group - {word}
    form = {}
    for word in n:
        best = min(near[word], key=lambda other: (-n[other], other), default=None)
        form[word] = best if best and n[best] >= 10 * n[word] else None
    out = []
    for word in n:
        root = word
        while form[root]:
            root = form[root]
        out.append((word, form[word], root, n[word], len(near[word]), n.get(form[word])))
    return sorted(out)


def random_words(seed, letters="abcdefghijklmnopqrstuvwxyzßéÿ×", n=120):
    """Words and variants of them with very different counts; chains of forms come up."""
    r = random.Random(seed)
    words = {}
    for _ in range(n):
        word = "".join(r.choice(letters) for _ in range(r.randrange(7, 12)))
        count = 2_000
        while count >= 2 and len(word) >= 7:
            words[word] = max(count, words.get(word, 0))
            i = r.randrange(len(word))
            word = word[:i] + r.choice(["", r.choice(letters), r.choice(letters) + word[i]]) + word[i + 1 :]
            count //= r.choice([3, 10, 11])
    return words


@pytest.mark.parametrize("shard_words", [0, 8, 50_000])
@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnopqrstuvwxyzßéÿ×"])
def test_variants(spark, letters, shard_words):
    words = random_words(len(letters), letters)
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    found = spelling.group_variants(frame, shard_words=shard_words).collect()
    assert sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found) == brute_variants(words)
    assert any(r.root not in (r.form, r.word) for r in found)


def test_words_of_very_many_letters(spark):
    words = {"a" * k: k for k in range(7, 600, 1)} | {"a" * 255 + "b": 9, "é" + "a" * 255: 9, "\u0100" + "a" * 255: 9}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    for shard_words in (0, 50_000):
        found = {r.word: r.n_near for r in spelling.group_variants(frame, shard_words=shard_words).collect()}
        assert found == {row[0]: row[4] for row in brute_variants(words)}


def test_spelling_of_documents(spark):
    r = random.Random(5)
    vocabulary = list(random_words(5, n=30))
    rows = [(i if i % 9 else None, "; ".join(r.choice(vocabulary).title() for _ in range(200))) for i in range(60)]
    rows += [(i % 3, "Überraschung Aÿÿÿÿÿÿ÷b " * 40 + "y" * 500) for i in range(20)]
    docs = documents(spark, rows, word="clash", n="clash", near="clash", key="clash")
    found = sorted((x.word, x.form, x.root, x.n, x.n_near, x.form_n) for x in spelling.spelling_variants(docs).collect())
    assert found == brute_variants(brute_words(rows))
    edge = sorted((x.word, x.n) for x in spelling.word_counts(edge_documents(spark)).collect())
    assert edge == sorted(brute_words(ROWS).items())
    assert spelling.spelling_variants(docs.limit(0)).collect() == []


def test_word_counts_pass_on_what_outgrows_them(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(spelling, "HELD_WORDS", 10)
    r = random.Random(6)
    rows = [(i, " ".join("".join(r.choice("xyz") for _ in range(8)) for _ in range(30))) for i in range(50)]
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in part], "text": [t for _, t in part]}) for part in (rows[:20], rows[20:])]
    total = Counter()
    for batch in spelling._count_words(iter(batches)):
        for word, n in zip(*(column.to_pylist() for column in batch.columns)):
            total[word] += n
    assert {word: n for word, n in total.items() if n >= 2} == brute_words(rows)


def test_checksums_of_runs():
    import pyarrow as pa

    runs = ["a" * k for k in (1, 7, 63, 64, 65, 200)] + ["größe", "ÿ" * 100]
    data, offsets = column_bytes(pa.array([" ".join(runs)]))
    starts, ends = spelling.letter_runs(data, offsets)
    before = np.array([zlib.crc32(f"{i}:".encode()) for i in range(len(runs))], np.uint32)
    found = spelling.run_checksums(data, starts, ends, before).tolist()
    assert found == [zlib.crc32(f"{i}:{run}".encode()) for i, run in enumerate(runs)]
