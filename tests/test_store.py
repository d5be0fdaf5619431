"""Stores: one version per change, kept state of keys, folders that stay few, wider ids, and upkeep."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from deedflow.operators.components import connected
from deedflow.plans import conflicts
from deedflow.plans.load import QUARANTINE, BatchRejected, apply_batch, load_all, reload_all, store_changes
from deedflow.operators import integrity
from deedflow.session import folder_names
from deedflow.sources import store as stores
from deedflow.sources.literals import literal_batch
from deedflow.sources.store import SchemaMismatch, SnapshotStore
from tests import fixture_rows as fx

DAY = dt.date(2020, 1, 1)


def company_rows(spark, *keys):
    return literal_batch(spark, "companies", [(k, f"c{k}", "Town") for k in keys])


def keys_of(store, name="companies", key="company_ID"):
    return sorted(r[0] for r in store.table(name).select(key).collect())


def test_a_reload_that_fails_keeps_the_old_rows(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    load_all(store, {"companies": company_rows(spark, 1, 2)})
    before = store.version
    owners = literal_batch(spark, "owners", [(1, "a", "b", "x"), (1, "a", "b", "y")])
    with pytest.raises(BatchRejected):
        reload_all(store, {"companies": company_rows(spark, 3), "owners": owners})
    assert store.version == before
    assert keys_of(store) == keys_of(SnapshotStore(spark, store.root)) == [1, 2]
    # What the failed load wrote is gone.
    assert store.sweep() == 0
    reload_all(store, {"companies": company_rows(spark, 3)})
    assert keys_of(store) == [3]
    assert store.version.number == before.number + 1


def test_readers_see_nothing_of_a_load_before_its_end(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    load_all(store, {"companies": company_rows(spark, 1)})
    with store.one_change():
        apply_batch(store, "companies", company_rows(spark, 2))
        apply_batch(store, "agents", literal_batch(spark, "agents", [(1, 2, "a", "b", "x", None)]))
        assert keys_of(store) == [1, 2]
        assert keys_of(SnapshotStore(spark, store.root)) == [1]
        with pytest.raises(ValueError):
            store.sweep()
    assert keys_of(SnapshotStore(spark, store.root), "agents", "agent_ID") == [1]
    number = store.version.number
    with pytest.raises(RuntimeError), store.one_change():
        store.clear()
        raise RuntimeError
    assert keys_of(store) == [1, 2] and store.version.number == number


def test_folders_stay_few_and_a_batch_reads_its_own_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "MERGED", 3)
    store = SnapshotStore(spark, str(tmp_path), buckets=8)
    rows = [(k, None, "House", "For Sale", "Town", Decimal(1), Decimal(1)) for k in range(40)]
    store.add("properties", literal_batch(spark, "properties", rows).drop("seq"))
    status = dict.fromkeys(range(40), "For Sale")
    r = random.Random(1)
    for step in range(20):
        changed = {r.randrange(40): r.choice(["Sold", "For Sale", "On Hold"]) for _ in range(2)}
        store.set_status(spark.createDataFrame(list(changed.items()), "property_ID int, prop_status string"))
        status |= changed
        assert len(store.version.logs["status"]) <= 3 * 3
    found = store.table("properties").select("property_ID", "prop_status").collect()
    assert dict(map(tuple, found)) == status
    one = spark.createDataFrame([(7,)], "property_ID int")
    kept = store.state("status", one)
    files = kept.inputFiles()
    assert len({f.split("bucket=")[1].split("/")[0] for f in files}) == 1 and len(files) <= 9
    assert {x.property_ID: (x.prop_status, x.property_TYPE) for x in kept.collect()}[7] == (status[7], "House")
    store.compact("properties")
    assert not any(run.changes for run in store.version.logs["status"])
    assert dict(map(tuple, store.table("properties").select("property_ID", "prop_status").collect())) == status


def test_small_batches_are_brought_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "MERGED", 3)
    store = SnapshotStore(spark, str(tmp_path))
    for k in range(7):
        batch = literal_batch(spark, "companies", [(k, "c", "Town"), (k, "again", "Town")])
        apply_batch(store, "companies", batch, QUARANTINE)
    assert keys_of(store) == list(range(7))
    assert len(store.version.folders["companies"]) <= 4 and len(store.version.rejected["companies"]) <= 4
    assert {tuple(r.reasons) for r in store.rejected("companies").collect()} == {("duplicate:company_ID",)}
    assert store.rejected("companies").count() == 7
    store.sweep(versions=2)
    assert len(folder_names(spark, f"{store.root}/versions")) == 2
    assert keys_of(SnapshotStore(spark, store.root)) == list(range(7))
    store.compact("companies")
    store.sweep()
    kept = {p for run in store.version.folders["companies"] + store.version.rejected["companies"] for p in [run.path]}
    on_disk = {f"companies/{name}" for name in folder_names(spark, f"{store.root}/companies")}
    assert on_disk == {"/".join(p.split("/")[:2]) for p in kept} and len(on_disk) == 2
    assert store.rejected("companies").count() == 7


def test_state_follows_batches_deletes_and_renumbering(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    load_all(store, fx.batches(spark))

    def check():
        contracts, sales = store.table("contracts_owner"), store.table("transactions")
        days = contracts.filter("property_ID IS NOT NULL").groupBy("property_ID").agg(F.min("date_contract"))
        assert sorted(map(tuple, store.state("contract_days").collect())) == sorted(map(tuple, days.collect()))
        counts = sales.filter("property_ID IS NOT NULL").groupBy("property_ID").agg(F.count("*"), F.min("date_transaction"))
        assert sorted(map(tuple, store.state("sales").collect())) == sorted(map(tuple, counts.collect()))
        status = store.state("status").select("property_ID", "property_TYPE", "prop_status")
        rows = store.table("properties").select("property_ID", "property_TYPE", "prop_status")
        assert sorted(map(tuple, status.collect())) == sorted(map(tuple, rows.collect()))

    check()
    gone = spark.createDataFrame([(2651,)], "property_ID int")
    moved = spark.createDataFrame([(2736, 2999)], "old_key int, new_key int")
    store_changes(store, integrity.delete_rows(store.tables(), "properties", gone))
    store_changes(store, integrity.renumber_rows(store.tables(), "properties", moved))
    check()
    assert store.state("sales").filter("property_ID = 2999").count() == 1


def test_ids_are_as_wide_as_the_version_says(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    apply_batch(store, "companies", company_rows(spark, 1))
    wide = spark.createDataFrame([(1, 5_000_000_000, "a", "b")], "seq long, company_ID long, comp_name string, city string")
    with pytest.raises(BatchRejected, match="type:company_ID"):
        apply_batch(store, "companies", wide)
    store.widen(10)
    apply_batch(store, "companies", wide)
    assert keys_of(store) == [1, 5_000_000_000]
    again = SnapshotStore(spark, store.root, id_digits=10)
    assert again.version == store.version and again.table("companies").schema["company_ID"].dataType.simpleString() == "bigint"
    assert again.specs["reviews"].fields[0].digits == 9
    for digits in (6, 12):
        with pytest.raises(SchemaMismatch):
            SnapshotStore(spark, store.root, id_digits=digits)
    with pytest.raises(SchemaMismatch):
        store.widen(8)
    # A reference across the widths.
    apply_batch(store, "agents", literal_batch(spark, "agents", [(1, 1, "a", "b", "x", None)]))


@pytest.mark.parametrize("seed", [1, 2])
def test_mixed_batches_are_those_of_a_host(spark, tmp_path, seed):
    rng = random.Random(seed)
    kinds = {k: rng.choice(["House", "House", "Villa"]) for k in range(1, 9)}
    status = {k: rng.choice(["Sold", "For Sale", "On Hold"]) for k in kinds}
    store = SnapshotStore(spark, str(tmp_path))
    rows = [(k, None, kinds[k], status[k], "Town", Decimal(1), Decimal(1)) for k in kinds]
    store.add("properties", literal_batch(spark, "properties", rows).drop("seq"))
    keys, days, sold_ids, contract_ids = set(), [], set(), set()
    logged = []
    for part in range(2):
        numbers = rng.sample(range(1_000), 90)
        numbers += rng.choices(numbers, k=6)
        events = []
        for seq in numbers:
            place = rng.choice([1, 1, 1, *kinds, None, 77])
            key = rng.randrange(part * 40, part * 40 + 70)
            day = rng.choice([DAY + dt.timedelta(rng.randrange(40)), DAY, None] if rng.random() < 0.3 else [DAY + dt.timedelta(rng.randrange(40))])
            events.append((seq, rng.random() < 0.55, key, place, day, rng.choice([None, "No", "No", "Yes"])))
        sales = [(s, k, p, None, None, None, d) for s, sale, k, p, d, _ in events if sale]
        contracts = [(s, k, p, None, d, e) for s, sale, k, p, d, e in events if not sale]
        sales = spark.createDataFrame(
            [(s, k, p, d) for s, k, p, *_, d in sales], "seq long, transaction_ID int, property_ID int, date_transaction date"
        )
        contracts = spark.createDataFrame(
            [(s, k, p, d, e) for s, k, p, _, d, e in contracts],
            "seq long, contract_ID int, property_ID int, date_contract date, exclusivity string",
        )
        wanted = {}
        for seq, sale, key, place, day, exclusive in sorted(events, key=lambda e: e[0]):
            alone = numbers.count(seq) == 1 and place != 77 and day is not None
            if sale:
                accepted = alone and key not in sold_ids and status.get(place) != "Sold"
                if accepted:
                    sold_ids.add(key)
                    logged.append(key)
                    if place in status:
                        status[place] = "Sold"
            else:
                clash = (day, "Yes") in days or ((day, "No") in days and exclusive == "Yes")
                accepted = alone and key not in contract_ids and not clash
                if accepted:
                    contract_ids.add(key)
                    days.append((day, exclusive))
                    if kinds.get(place) == "House":
                        status[place] = "For Sale"
            wanted.setdefault((sale, seq), []).append(accepted)
        result = apply_batch(store, "transactions", sales, QUARANTINE, contracts=contracts, hot_rows=3 if seed == 1 else None)
        found = {}
        for sale, frame, accepted in (
            (True, result.accepted, True), (True, result.rejected, False),
            (False, result.contracts.accepted, True), (False, result.contracts.rejected, False),
        ):
            for row in frame.collect():
                found.setdefault((sale, row.seq), []).append(accepted)
        assert found == wanted
        assert dict(map(tuple, store.table("properties").select("property_ID", "prop_status").collect())) == status
        log = store.table("log_transactions").orderBy("log_ID").collect()
        assert [r.transaction_id for r in log] == logged and [r.log_ID for r in log] == list(range(1, len(logged) + 1))


def test_an_atomic_mixed_batch_names_the_first_reject(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    store.add("properties", literal_batch(spark, "properties", [(1, None, "Villa", "Sold", "T", Decimal(1), Decimal(1))]).drop("seq"))
    sales = spark.createDataFrame([(5, 1, 1, DAY)], "seq long, transaction_ID int, property_ID int, date_transaction date")
    schema = "seq long, contract_ID int, property_ID int, date_contract date, exclusivity string"
    contracts = spark.createDataFrame([(1, 1, 1, DAY, "Yes"), (7, 2, 1, DAY, "Yes")], schema)
    before = store.version
    with pytest.raises(BatchRejected, match="already sold") as refused:
        apply_batch(store, "transactions", sales, contracts=contracts)
    assert (refused.value.table, refused.value.seq) == ("transactions", 5) and store.version == before
    with pytest.raises(ValueError):
        apply_batch(store, "owners", sales, contracts=contracts)


def host_order(rows):
    """seq of the stored rows: (seq, a, b, group, kind), first come, first served."""
    held, bars, stored = [set(), set()], {}, []
    for seq, a, b, group, kind in sorted(rows):
        if a in held[0] or b in held[1]:
            continue
        if group is not None and (bars.get(group) == "alone" or (bars.get(group) == "shared" and kind == "alone")):
            continue
        if group is not None and kind != "mute":
            bars[group] = kind
        for value, seen in ((a, held[0]), (b, held[1])):
            if value is not None:
                seen.add(value)
        stored.append(seq)
    return stored


@pytest.mark.parametrize("most", [10, 60, 200_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_conflicts_are_settled_in_order(spark, seed, most):
    r = random.Random(seed)
    rows = []
    for i, seq in enumerate(r.sample(range(10_000), 260)):
        a, b = (r.choice([None, r.randrange(60)]), r.choice([None, f"v{r.randrange(60)}"])) if i % 3 else (1_000 + i // 30, None)
        rows.append((seq, a, b, r.choice([None, None, *range(30)]), r.choice(["alone", "shared", "mute"])))
    frame = spark.createDataFrame(rows, "seq long, a int, b string, g int, _kind string")
    found = conflicts.settle(frame, ["a", "b"], ["g"], most=most)
    assert sorted(x.seq for x in found.collect()) == host_order(rows)


@pytest.mark.parametrize("length", [40, 10_000])
def test_a_chain_of_any_length_is_settled_at_once(spark, length, monkeypatch):
    rounds = []
    monkeypatch.setattr(conflicts, "_round", lambda *a: rounds.append(a))
    rows = [(i, (i + 1) // 2, i // 2) for i in range(length)]
    frame = spark.createDataFrame(rows, "seq long, a int, b int")
    found = conflicts.settle(frame, ["a", "b"])
    assert sorted(x.seq for x in found.collect()) == list(range(0, length, 2)) and not rounds


def test_components_of_long_chains_take_few_rounds(spark):
    n = 300
    edges = [(i, f"{k}") for i in range(n) for k in (i, i + 1)] + [(1_000 + i, "hot") for i in range(200)] + [(5_000, None), (6_000, "x")]
    random.Random(1).shuffle(edges)
    found = dict(map(tuple, connected(spark.createDataFrame(edges, "node long, link string"), "node", "link").collect()))
    assert found == {i: 0 for i in range(n)} | {1_000 + i: 1_000 for i in range(200)} | {5_000: 5_000, 6_000: 6_000}
