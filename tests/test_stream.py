"""Rows that arrive in several files are stored under the rules, each once."""

from decimal import Decimal

from deedflow.plans.load import load_all
from deedflow.sources.literals import literal_batch
from deedflow.sources.store import SnapshotStore
from deedflow.streaming.ingest import ingest
from tests import fixture_rows as fx


def test_ingest(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    some = ("companies", "owners", "properties", "agents", "clients")
    load_all(store, {k: v for k, v in fx.batches(spark).items() if k in some})

    def sale(key, property_id):
        return (key, property_id, 4651, 3147, Decimal(5), fx.day("2024-01-01"))

    def arrive(number, *sales, folder="in"):
        batch = literal_batch(spark, "transactions", sales, fx.SALE_COLUMNS)
        batch.coalesce(1).write.parquet(str(tmp_path / folder / f"part={number}"))

    def run(checkpoint="checkpoint", folder="in"):
        schema = literal_batch(spark, "transactions", [], fx.SALE_COLUMNS).schema
        arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
        rows = arriving.parquet(str(tmp_path / folder / "part=*"))
        query = ingest(rows, "transactions", store, str(tmp_path / checkpoint))
        query = query.trigger(availableNow=True).start()
        query.awaitTermination(300)
        assert query.exception() is None

    arrive(1, sale(1, 2651), sale(2, 2651))
    run()
    assert store.table("transactions").count() == 1
    # A later batch sees what the earlier ones stored.
    arrive(2, sale(3, 2651), sale(4, 2736), sale(1, 2095))
    run()
    assert sorted(r[0] for r in store.table("transactions").select("transaction_ID").collect()) == [1, 4]
    log = store.table("log_transactions").orderBy("log_ID").select("log_ID", "transaction_id").collect()
    assert [tuple(r) for r in log] == [(1, 1), (2, 4)]
    rejected = store.rejected("transactions").orderBy("transaction_ID", "property_ID").collect()
    assert [(r.transaction_ID, r.reasons) for r in rejected] == [
        (1, ["duplicate:transaction_ID"]), (2, ["already_sold"]), (3, ["already_sold"]),
    ]
    # Going on without new files changes nothing.
    version = store.version
    run()
    assert store.version == version
    # Another source starts counting anew, and so does the same one with a new checkpoint.
    arrive(1, sale(50, 2095), folder="other")
    run("other-checkpoint", "other")
    stored = {r[0] for r in store.table("transactions").select("transaction_ID").collect()}
    assert 50 in stored or store.rejected("transactions").filter("transaction_ID = 50").count() == 1
    before = store.rejected("transactions").count()
    run("new-checkpoint")
    assert store.rejected("transactions").count() == before + 5
