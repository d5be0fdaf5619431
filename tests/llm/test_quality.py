"""Statistics and rules against plain Python; classifiers by held-out accuracy."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from deedflow.llm import pu_quality, tree_rules
from deedflow.llm.queries import QUERIES
from tests.llm.edge_rows import CLASHING, edge_documents

FOLDER = "/root/testdata/sf0.01"


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def check_base(rows, texts):
    for row in rows:
        n, chars, symbols, duplicates, repeated = base(texts[row.doc_id])
        assert (row.n_words, row.word_chars, row.n_symbols) == (n, chars, symbols)
        assert (row.n_dup_lines, row.n_repeat_words) == (duplicates, repeated)
        assert row.base_failed == (n < 10 or 100 * repeated > 20 * n)
        assert not (row.base_failed and row.kept)


def test_base_counts_of_the_given_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op3_tree_rules"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    check_base(rows, texts)


def test_edge_rows(spark):
    docs = edge_documents(spark).where("doc_id IS NULL OR doc_id NOT IN (1, 6)")
    texts = {r.doc_id: r.text for r in docs.where("doc_id IS NOT NULL").collect()}
    rows = tree_rules.judge_quality(docs, None).collect()
    assert len(rows) == docs.count()
    check_base([r for r in rows if r.doc_id is not None], texts)
    kept = tree_rules.keep_good(edge_documents(spark), None)
    assert kept.columns == edge_documents(spark).columns and set(CLASHING) <= set(kept.columns)
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 1, 2, 7]
    empty = edge_documents(spark).limit(0)
    assert tree_rules.judge_quality(empty, None).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert tree_rules.train(empty, labels) is None
    assert pu_quality.train(empty, labels) == (None, 0.5)
    scores = pu_quality.score_documents(edge_documents(spark), None).collect()
    assert {r.score for r in scores} == {0.5} and len(scores) == edge_documents(spark).count()


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.mark.parametrize(("name", "column"), [("op2_pu_quality", "predicted"), ("op3_tree_rules", "kept")])
def test_held_out_accuracy(spark, name, column):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES[name](spark, folder).collect() if r.doc_id in labels and held_out(r.doc_id)]
    good = [r for r in rows if labels[r.doc_id] == 1]
    bad = [r for r in rows if labels[r.doc_id] == 0]
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([bool(r[column]) for r in good]) > 0.95
    assert np.mean([not r[column] for r in bad]) > 0.9
    if name == "op2_pu_quality":
        assert all(r.held_out == held_out(r.doc_id) and r.predicted == (r.score >= 0.3) for r in rows)


def test_trees_are_monotone_and_flat_scoring_walks_them():
    random = np.random.default_rng(1)
    x = random.random((3000, 3))
    y = (random.random(3000) < 1 / (1 + np.exp(6 * x[:, 0] - 3 + np.sin(9 * x[:, 1])))).astype(float)
    forest = tree_rules.grow_forest(x, y, [-1, 0, 0])
    grid = np.repeat(random.random((50, 3)), 40, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 40), 50)
    assert (np.diff(forest.scores(grid).reshape(50, 40), axis=1) <= 1e-12).all()

    def walk(row):
        total = forest.start
        for node in forest.roots:
            while forest.left[node] != node:
                node = forest.left[node] if row[forest.feature[node]] <= forest.bound[node] else forest.right[node]
            total += forest.value[node]
        return total

    assert np.allclose(forest.margins(x[:100]), [walk(row) for row in x[:100]])
    assert np.mean((forest.scores(x) > 0.5) == y) > 0.75


def test_estimated_prior_and_risk():
    random = np.random.default_rng(2)
    positive = random.normal(2, 1, (8000, 4))
    mixture = np.concatenate([random.normal(2, 1, (5600, 4)), random.normal(-2, 1, (2400, 4))])
    first = pu_quality.fit(positive[:4000], mixture[::2], None)
    prior = pu_quality.estimated_prior(first.scores(positive[4000:]), first.scores(mixture[1::2]))
    assert abs(prior - 0.7) < 0.06
    scores = pu_quality.fit(positive, mixture, prior).scores(mixture)
    assert (scores[:5600] > 0.3).mean() > 0.97 and (scores[5600:] < 0.3).mean() > 0.97


def test_samples_are_bounded_whatever_repeats(spark):
    docs = spark.range(20_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    docs = docs.unionAll(spark.range(2, 300).select("id", F.lit("other")))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    sample = tree_rules.labelled_sample(docs, labels, "quality", most=100)
    found = sample.collect()
    assert len(found) == 100 == len({r.doc_id for r in found})
    assert sorted(map(tuple, found)) == sorted(map(tuple, tree_rules.labelled_sample(docs, labels, "quality", most=100).collect()))
    assert tree_rules.labelled_sample(docs.limit(0), labels, "quality").collect() == []
