"""How much is written and shuffled, and that results do not depend on which way was taken."""

import pytest

from deedflow.operators import components
from deedflow.plans import conflicts, judge as judging
from deedflow.plans.judge import judge
from deedflow.plans.load import apply_batch
from deedflow.sources.literals import literal_batch
from deedflow.sources.store import SnapshotStore


def rows_written(monkeypatch, module):
    counts, cut = [], module.cut_lineage

    def counting(rows, label):
        kept = cut(rows, label)
        counts.append(kept.count())
        return kept

    monkeypatch.setattr(module, "cut_lineage", counting)
    return counts


@pytest.mark.parametrize("step", [1, -1])
def test_rounds_of_a_long_chain_together_write_little_more_than_the_first(spark, monkeypatch, step):
    n = 2_000
    written = rows_written(monkeypatch, components)
    edges = spark.createDataFrame([(step * i, k) for i in range(n) for k in (i, i + 1)], "node long, link long")
    found = components.connected(edges, "node", "link").collect()
    assert {tuple(row) for row in found} == {(step * i, min(0, step * (n - 1))) for i in range(n)}
    assert sum(written) < 15 * n


def test_every_row_is_decided_whatever_keys_it_lacks(spark):
    rows = [(1, 1, "x"), (2, None, "x"), (3, 1, "y"), (4, None, "y"), (5, None, None), (6, 2, None), (7, 2, None), (8, None, "y")]
    frame = spark.createDataFrame(rows, "seq long, a int, b string")
    for most in (2, 4, 200_000):
        found = {r.seq: (r.a, r.b, r._stored) for r in conflicts.decided(frame, ["a", "b"], most=most).collect()}
        assert found == {s: (a, b, s in (1, 4, 5, 6)) for s, a, b in rows}


@pytest.mark.parametrize("small", [0, 20_000])
def test_keys_and_references_take_one_shuffle(spark, tmp_path, monkeypatch, capsys, small):
    monkeypatch.setattr(judging, "SMALL_BATCH", small, raising=False)
    store = SnapshotStore(spark, str(tmp_path))
    apply_batch(store, "companies", literal_batch(spark, "companies", [(1, "c", "Town")]))
    apply_batch(store, "agents", literal_batch(spark, "agents", [(1, 1, "a", "b", "x", None), (2, None, "a", "b", "y", None)]))
    batch = literal_batch(
        spark, "agents",
        [(1, 1, "a", "b", "u", None), (3, 2, "a", "b", "x", None), (4, 1, "a", "b", "v", None), (4, None, "a", "b", "w", None), (5, 1, "a", "b", "z", None)],
    )
    tables, plans, cut = store.tables(), [], judging.cut_lineage

    def looked_at(rows, label):
        if not label.startswith("typed"):
            rows.explain()
            plans.append((label, capsys.readouterr().out.count("Exchange hashpartitioning")))
        return cut(rows, label)

    monkeypatch.setattr(judging, "cut_lineage", looked_at)
    judged = judge("agents", batch, tables).orderBy("seq").collect()
    assert [sorted(r.reasons) for r in judged] == [
        ["duplicate:agent_ID"], ["duplicate:contact", "orphan:company_ID"], [], ["duplicate:agent_ID"], []
    ]
    assert plans[0][0] == "exceptions-agents"
    if not small:
        assert plans[0][1] == 1
