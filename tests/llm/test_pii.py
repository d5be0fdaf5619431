"""Personal data against Python's re, and what weak supervision adds."""

import hashlib
import re

import numpy as np
import pytest

from deedflow.llm import pii
from tests.llm.edge_rows import ROWS, documents, edge_documents

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "a@b.c a@b a@b. a@b..c x.y+z%w@b-c.d-e.f.g_h@i.j @b.c a@@b.c",
    "a@b.c_d@e.f,a@b.c@d.e a@b.c@d",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.255 001.002.003.004 0000000000000000255.1.1.1 1.2.3 99999999999.1.1.1",
    "4111111111111111 4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 41111111111111112 4111111111111111-",
    "0000000000000 123456789012 6011000990139424 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0",
    "+1 (487) 555-7209 +44 20 7946 0958 +1 23 + 12345678 ++123456789 +1(2)3.4-5 6 7 8 9 0 1 2 3 4 5 6 +123456789.",
    "\U0001f600 é a@b.c \U0001f600 10.0.0.1\n10.0.0.2 4111 1111\n1111 1111 +1 487 555\n7209",
    'call 555-234-7788 or (212) 555-0188. token = "9f86d081884c7d659a2feaa0c55ad015" Dr. Maria Lopez and House Of',
    "a." * 3000 + "@" + "b." * 3000,
    "1" * 30_000 + ".1.1.1",
    "+" + "1 " * 20_000,
]


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split(".") if len(part) < 4000) and max(map(len, match.split("."))) < 4000
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return {
        kind: [(m.start(), m.end()) for m in re.finditer(pattern, text or "") if passes(kind, m.group())]
        for kind, pattern in PATTERNS.items()
    }


def test_base_spans(spark):
    rows = [*ROWS, *((100 + i, t) for i, t in enumerate(TEXTS))]
    docs = documents(spark, rows, spans="x", email="x", _text="x")
    found = pii.find_personal_data(docs, pii.Model({}, {kind: {("bias", 0): -1.0} for kind in pii.ADDED}))
    listed = found.select("doc_id", *pii.BASE, pii.span_list(*pii.BASE).alias("listed"), pii.span_list(*pii.ADDED).alias("added")).collect()

    def spans(row):
        return tuple((k, [(s.s, s.e) for s in row[k]]) for k in PATTERNS)

    expected = sorted(((str(d), tuple(brute(t).items())) for d, t in rows), key=str)
    assert sorted(((str(r.doc_id), spans(r)) for r in listed), key=str) == expected
    assert all(r.added == "" for r in listed)
    for row in listed:
        assert row.listed == ",".join(f"{k}:{a}:{b}" for k, places in spans(row) for a, b in places)
        assert len(hashlib.sha256(row.listed.encode()).hexdigest()) == 64
    assert pii.find_personal_data(docs.limit(0), pii.learn(docs.limit(0))).count() == 0


@pytest.fixture
def corpus(spark):
    key = hashlib.sha256
    rows = []
    for i in range(120):
        rows.append((i, f'the word token = "{key(str(i).encode()).hexdigest()[:40]}" here and some_long_name_of_a_part{i % 10} there'))
        rows.append((1000 + i, f"please call 212-555-{1000 + i} at once, and see No 112-055-{2000 + i} too"))
        rows.append((2000 + i, f"Dr. Maria Lopez met Prof. Peter Kraus. Winter Came. The end is near Open Water {i}"))
    return documents(spark, rows), dict(rows)


def test_added_spans(corpus):
    docs, texts = corpus
    model = pii.learn(docs)
    found = pii.find_personal_data(docs, model).collect()
    picked = {kind: {texts[r.doc_id][s.s : s.e] for r in found for s in r[kind]} for kind in pii.ADDED}
    assert len(picked["secret"]) == 120 and not any(x.startswith("some") for x in picked["secret"])
    assert {f"212-555-{1000 + i}" for i in range(120)} <= picked["local_phone"]
    assert {"Maria Lopez", "Peter Kraus"} <= picked["name"]
    assert not {"Winter Came", "Open Water"} & picked["name"]
    for r in found:
        base = [s for kind in pii.BASE for s in r[kind]]
        assert not any(s.s < b.e and b.s < s.e for kind in pii.ADDED for s in r[kind] for b in base)


def test_estimated_reliabilities():
    random = np.random.default_rng(4)
    true = random.random(20_000) < 0.4
    votes = []
    for accuracy, silent in ((0.95, 0.1), (0.8, 0.3), (0.6, 0.5)):
        right = np.where(random.random(20_000) < accuracy, np.where(true, 1, -1), np.where(true, -1, 1))
        votes.append(np.where(random.random(20_000) < silent, 0, right))
    patterns, counts = np.unique(np.stack(votes, axis=1), axis=0, return_counts=True)
    table, chance = pii.estimate([(tuple(p), int(n)) for p, n in zip(patterns.tolist(), counts, strict=True)])
    strength = [table[1, j, 2] / (table[1, j, 2] + table[1, j, 0]) for j in range(3)]
    assert np.allclose(strength, [0.95, 0.8, 0.6], atol=0.06)
    assert abs((chance * counts).sum() / counts.sum() - 0.4) < 0.05
