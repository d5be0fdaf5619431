"""Archives, mixtures and shards: round trips, brute force and laws."""

import gzip
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from deedflow.llm import decontaminate, mixing, near_dedup, sharding, tree_rules, warc
from deedflow.llm.queries import DOMAIN, MIX_LEVELS, MIX_WEIGHTS
from tests.llm.edge_rows import ROWS, documents, edge_documents
from tests.llm.test_documents import brute_components, brute_overlaps, order, words

PAGES = [
    (1, "http://a.b/c d?é=\n1", "<p>same</p>"),
    (2, None, "<p>same</p>"),
    (5, "u", "<p>same</p>"),
    (5, "v", "<p>same</p>"),
    (3, "u", None),
    (4, "u", ""),
    (6, "u", "\r\n\r\n0\r\n\r\nWARC/1.1\r\n" * 3),
    (7, "u", "é\U0001f600" * 40_000),
    (None, "u", "<p>alone</p>"),
    (None, "u", "<p>same</p>"),
    (8, "u", "x" * warc.SEGMENT_BYTES),
]


def test_archives(spark):
    pages = spark.createDataFrame([(*p, "x", "x") for p in PAGES], "page_id long, url string, html string, payload string, origin string")
    found = warc.warc_round_trip(pages).collect()
    owner = defaultdict(lambda: -1)
    for page_id, _, html in PAGES:
        if page_id is not None:
            owner[html or ""] = max(owner[html or ""], page_id)
    expected = []
    for page_id, _, html in PAGES:
        payload = (html or "").encode()
        largest = owner[html or ""]
        revisit = largest != -1 and page_id != largest
        expected.append((page_id, "revisit" if revisit else "response", largest if revisit else None, len(payload), warc.bare_digest(payload), None if revisit else payload, None))
    assert sorted((tuple(r) for r in found), key=str) == sorted(expected, key=str)
    assert warc.warc_round_trip(pages.limit(0)).count() == 0


def test_long_records_are_cut(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abc" * 1000)], "page_id long, url string, html string")
    folder = str(tmp_path / "warc")
    warc.write_archives(pages, folder, segment_bytes=500)
    records = warc.read_records(spark, folder).orderBy("segment").collect()
    assert [r.segment for r in records] == list(range(1, len(records) + 1)) and len(records) > 5
    assert {r.record_type for r in records[1:]} == {"continuation"} and records[0].record_type == "response"
    assert records[-1].total == sum(len(r.block) for r in records)
    assert warc.read_archives(spark, folder).first().payload == b"abc" * 1000
    # Files are archives as they are: records end with a blank line.
    data = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "warc").glob("part-*"))
    assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")


def broken(drop=None, change=None):
    records = warc.records_of("n", 1, "u", b"abc" * 400, None, 300)
    records = [change(r) if change else r for i, r in enumerate(records) if i != drop]
    return b"".join(r + b"\r\n\r\n" for r in records)


@pytest.mark.parametrize(
    ("data", "problem"),
    [
        (broken(drop=1), "segment missing"),
        (broken(drop=4), "length differs"),
        (broken(change=lambda r: r.replace(b"abcabc", b"abcxbc")), "digest differs"),
        (broken(change=lambda r: r.replace(b"Total-Length: 1", b"Total-Length: 9")), "length differs"),
    ],
)
def test_damage_is_reported(spark, tmp_path, data, problem):
    (tmp_path / "part-0.gz").write_bytes(gzip.compress(data))
    row = warc.read_archives(spark, str(tmp_path)).first()
    assert row.problem == problem


@pytest.mark.parametrize("kind", ["head", "length", "cut", "torn"])
def test_damaged_heads_cost_one_record(spark, tmp_path, kind):
    """What stands around a damaged record is read; a file that is cut is read up to there."""
    made = [warc.records_of(f"n{i}", i, "u", bytes(f"page {i} " * 500, "ascii"), None, 1 << 20)[0] for i in range(5)]
    if kind == "head":
        made[2] = made[2].replace(b"WARC/1.1", b"WXRC/1.1")
    elif kind == "length":
        made[2] = made[2].replace(b"Content-Length: ", b"Content-Length: x")
    elif kind == "cut":
        made[4] = made[4][:-9]
    # One member per record, as other writers do.
    data = b"".join(gzip.compress(r + b"\r\n\r\n", mtime=0) for r in made)
    (tmp_path / "part-0.gz").write_bytes(data[:-40] if kind == "torn" else data)
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    lost = {"head": 2, "length": 2}.get(kind, 4)
    assert {r.page_id for r in rows if r.problem is None} == set(range(5)) - {lost}
    assert "record damaged" in {r.problem for r in rows}


def test_heads_follow_the_standard(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/\u00e9", "same"), (2, "http://b/", "same"), (3, None, "x")], "page_id long, url string, html string")
    folder = str(tmp_path / "warc")
    warc.write_archives(pages, folder)
    data = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "warc").glob("part-*"))
    heads = [h for h in data.split(b"\r\n\r\n") if h.startswith(b"WARC/1.1")]
    assert all(b"\r\nContent-Type: application/http; msgtype=response" in h for h in heads)
    names = {re.search(rb"WARC-Record-ID: <(urn:uuid:[0-9a-f-]{36})>", h)[1] for h in heads}
    assert len(names) == len(heads) == 3
    revisit = next(h for h in heads if b"WARC-Type: revisit" in h)
    assert b"WARC-Target-URI: http://a/%C3%A9" in revisit and b"WARC-Refers-To-Target-URI: http://b/" in revisit
    assert b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" in revisit


def test_chunks():
    for size in (0, 1, 7, 8, 9, 100):
        payload = bytes(range(256))[:size] + b"\r\n0\r\n\r\n"
        assert warc.dechunked(warc.chunked(payload, 8)) == payload
    assert warc.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: z\r\n\r\n") == b"abc"
    with pytest.raises(ValueError, match="closed"):
        warc.dechunked(b"3\r\nabcd\r\n0\r\n\r\n")


def shares(budget, children):
    """Fill up children by room per weight, then share out what is left."""
    given, left = {}, dict(children)
    while left:
        total = sum(w for _, w in left.values())
        full = [k for k, (room, w) in left.items() if w and room * total <= w * budget]
        if not full:
            break
        first = min(full, key=lambda k: (left[k][0] / left[k][1], k))
        given[first] = left.pop(first)[0]
        budget -= given[first]
    total = sum(w for _, w in left.values())
    parts = {k: w * budget // total if total else 0 for k, (_, w) in left.items()}
    odd = budget - sum(parts.values()) if total else 0
    for k in sorted((k for k in left if left[k][1]), key=lambda k: (left[k][0] / left[k][1], k)):
        parts[k] += odd > 0
        odd -= 1
    return given | parts


def brute_budgets(leaves, weights, share, epochs):
    rooms = {path: n * epochs for path, n in leaves.items()}
    weight = lambda path: weights.get(("domain", "lang", "source")[len(path) - 1], {}).get(path[-1], 1)

    def room(path):
        below = [room(p) for p in {leaf[: len(path) + 1] for leaf in leaves if leaf[: len(path)] == path}] if len(path) < 3 else [rooms[path]]
        return sum(below) if not path or weight(path) else 0

    out = {}

    def go(path, budget):
        if len(path) == 3:
            out[path] = budget
            return
        children = {p: (room(p), weight(p)) for p in {leaf[: len(path) + 1] for leaf in leaves if leaf[: len(path)] == path}}
        for child, part in shares(budget, children).items():
            go(child, part)

    go((), min(sum(leaves.values()) * share[0] // share[1], room(())))
    return out


@pytest.mark.parametrize("share", [(1, 10), (8, 10), (15, 10), (9, 1)])
def test_budgets(spark, share):
    paths = [(d, g, s) for d in "ab" for g in ("en", "de", "") for s in "xyz"]
    leaves = {path: 900 if i == 3 else i * 37 % 101 for i, path in enumerate(paths)}
    rows = [(i, *path, n) for i, (path, n) in enumerate(leaves.items())]
    docs = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, n_tokens long")
    weights = {"domain": {"a": 3}, "lang": {"en": 5, "de": 2}, "source": {"z": 0, "y": 4}}
    found = mixing.leaf_budgets(docs, ["domain", "lang", "source"], weights, share, 2).collect()
    expected = brute_budgets(leaves, weights, share, 2)
    assert {tuple(r)[:3]: r.given for r in found if r.given} == {k: v for k, v in expected.items() if v}


def test_prefixes(spark):
    rows = [(i, "a" if i % 3 else "b", "en", f"s{i % 2}", i * 13 % 29) for i in range(400)] + [(None, None, None, None, 5)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, n_tokens long").withColumn("mix", F.lit(1))
    levels = ["domain", "lang", "source"]
    given = {tuple(r)[:3]: r.given for r in mixing.leaf_budgets(docs.na.fill(""), levels, {}, (13, 10), 3).collect()}
    found = mixing.mix(docs, levels, {}, (13, 10), 3, seed=5).collect()
    taken = Counter()
    for r in found:
        taken[r.domain, r.lang, r.source] += r.taken_tokens
        assert 0 <= r.taken_tokens <= r.n_tokens
    assert taken == Counter(given)
    for leaf in given:
        own = [r for r in found if (r.domain, r.lang, r.source) == leaf]
        last = max(r.epoch for r in own)
        for epoch in range(last):
            assert all(r.taken_tokens == r.n_tokens for r in own if r.epoch == epoch)
        assert sum(r.taken_tokens < r.n_tokens for r in own if r.epoch == last) <= 1
    again = mixing.mix(docs, levels, {}, (13, 10), 3, seed=5).collect()
    assert Counter(map(str, again)) == Counter(map(str, found))
    assert mixing.mix(docs.limit(0), levels, {}).count() == 0


def check_shards(rows, docs, shards, slack):
    sizes = defaultdict(list)
    for r in rows:
        sizes[r.shard].append(r)
    assert all(0 <= s < shards for s in sizes)
    for own in sizes.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    texts = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == texts
    bytes_of = [sum(r["size"] for r in sizes[s]) for s in range(shards)]
    assert max(bytes_of) - min(bytes_of) <= slack


@pytest.mark.parametrize("shards", [1, 5, 8])
def test_shards(spark, monkeypatch, shards):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 20)
    rows = [(i, f"text {i % 150} " * (1 + i % 7)) for i in range(700)] + [(1000 + i, "hot") for i in range(350)]
    docs = documents(spark, rows, lang="en", source="s", shard="x", slot="x", text_crc32="x")
    found = sharding.shard_documents(docs, shards=shards).collect()
    total = sum(len(t) + 16 for _, t in rows)
    check_shards(found, rows, shards, 200 + total / shards * sharding.GROUP * 4)
    assert Counter(map(str, sharding.shard_documents(docs, shards=shards).collect())) == Counter(map(str, found))


def brute_tree(rows, names, shards):
    """The shard of every row (dimensions, text and row hash, size) by the rule of the cuts, one node after the other."""
    target = sum(r["_size"] for r in rows) / shards

    def at(values, share):
        return sorted(values)[max(0, -(-len(values) * share // 1) - 1).__int__()]

    def cut(own, keys, goal, before, fixed):
        """The first values of ``keys`` at which rows go right."""
        groups = defaultdict(list)
        for r in own:
            groups[r[keys[0]]].append(r)
        values = sorted(groups)
        for value in values:
            size = sum(r["_size"] for r in groups[value])
            if before + size > goal or value == values[-1]:
                break
            before += size
        bound = target * (sharding.GROUP if len(fixed) == 1 else sharding.TOLERANCE)
        if len(groups[value]) > 1 and size > bound and len(keys) > 1:
            return cut(groups[value], keys[1:], goal, before, (*fixed, value))
        return (*fixed, value + 1 if before + size - goal < goal - before else value)

    def go(own, first, n):
        if n == 1 or not own:
            return {r["_row"]: first for r in own}
        reach = {d: (at([r[d] for r in own], 0.875) - at([r[d] for r in own], 0.125), max(r[d] for r in own) - min(r[d] for r in own)) for d in names}
        widest = max(names, key=reach.__getitem__)
        keys = (widest, "_text", "_row")
        bound = cut(own, keys, sum(r["_size"] for r in own) * (n // 2) / n, 0, ())
        left = [r for r in own if tuple(r[k] for k in keys[: len(bound)]) < bound]
        right = [r for r in own if tuple(r[k] for k in keys[: len(bound)]) >= bound]
        return go(left, first, n // 2) | go(right, first + n // 2, n - n // 2)

    return go(rows, 0, shards)


@pytest.mark.parametrize("shards", [2, 7])
def test_shards_are_those_of_a_tree_grown_node_by_node(spark, shards):
    rows = [(i, f"w{i % 90} " * (1 + i * 7 % 23)) for i in range(240)] + [(1000 + i, "hot and long " * 9) for i in range(60)]
    docs = documents(spark, rows, lang="en").withColumn("source", F.concat(F.lit("s"), (F.col("doc_id") % 5).cast("string")))
    dimensions = sharding.default_dimensions()
    names = [f"_d{i}" for i in range(len(dimensions))]
    keyed = sharding.group_keys(sharding.with_keys(docs, dimensions), names).collect()
    wanted = brute_tree([r.asDict() for r in keyed], names, shards)
    found = {r.doc_id: r.shard for r in sharding.shard_documents(docs, shards=shards).collect()}
    assert found == {r.doc_id: wanted[r._row] for r in keyed}


def test_many_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "MOST_RANGES", 2_000)
    rows = [(i, "x" * (30 + i * 31 % 200)) for i in range(4_000)]
    docs = documents(spark, rows, lang="en", source="s")
    total = sum(len(t) + 16 for _, t in rows)
    found = sharding.shard_documents(docs, target_bytes=-(-total // 400)).collect()
    check_shards(found, rows, 400, 1_500)
    assert len({r.shard for r in found}) == 400


def test_shards_of_edge_rows(spark):
    docs = edge_documents(spark)
    found = sharding.shard_documents(docs, shards=3).collect()
    check_shards(found, ROWS, 3, 400_000)
    assert sharding.shard_documents(docs.limit(0), shards=3).count() == 0
    assert {r.shard for r in sharding.shard_documents(docs, target_bytes=1 << 30).collect()} == {0}


def test_pipeline_by_brute_force(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels, items = spark.read.parquet(f"{folder}/labels.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    forest = tree_rules.train(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = [r.doc_id for r in tree_rules.judge_quality(docs, forest).collect() if r.kept]
    rows = sorted((d, texts[d]) for d in good)
    firsts = brute_components(rows)[1]
    leaked = {d for d, *_ in brute_overlaps([(d, texts[d]) for d in firsts], [tuple(r) for r in items.select("item_id", "text").collect()])}
    clean = [d for d in firsts if d not in leaked]
    kept = docs.filter(F.col("doc_id").isin(clean))
    sized = kept.withColumns({"domain": F.expr(DOMAIN), "n_tokens": mixing.word_count()})
    mixed = {r.doc_id: r.taken_tokens for r in mixing.mix(sized, MIX_LEVELS, MIX_WEIGHTS, corpus_pipeline.MIX_SHARE, 1, seed=17).collect()}
    assert sum(mixed.values()) == sum(len(words(texts[d])) for d in clean) * 9 // 10 or len(mixed) < len(clean)
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id for r in found) == sorted(mixed)
    for r in found:
        whole = words(texts[r.doc_id])
        if mixed[r.doc_id] == len(whole):
            assert r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        else:
            assert r["size"] < len(texts[r.doc_id].encode()) + 16
    assert {r.shard for r in found} <= set(range(40))


def test_stages_take_edge_rows(spark):
    folder = "/root/testdata/sf0.001"
    docs = edge_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        empty = stage(spark, docs.limit(0), folder)
        assert empty.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.count() <= len(ROWS)
        else:
            assert out.count() == len(ROWS)
    assert near_dedup.WIDTH == 4 and decontaminate.SPAN == 12 and order(None) > 0


def test_first_words(spark):
    rows = [(2, " a  b c"), (1, "x"), (0, "a"), (3, "é \U0001f600\nz w")]
    frame = spark.createDataFrame(rows, "n long, text string")
    assert [r[0] for r in frame.select(mixing.first_words("text", "n")).collect()] == [" a  b", "x", "", "é \U0001f600\nz"]
    long = spark.createDataFrame([(30_000, "w " * 60_000)], "n long, text string")
    assert long.select(F.length(mixing.first_words("text", "n"))).first()[0] == 59_999
