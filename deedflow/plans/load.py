"""Batches stored under the rules, one at a time or as a whole load."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedflow.operators.effects import audit_log, changed_status, openings
from deedflow.plans.judge import judge
from deedflow.session import cut_lineage, scratch_scope
from deedflow.sources.schema import LOAD_ORDER, TABLES
from deedflow.sources.store import SnapshotStore

ATOMIC = "atomic"
QUARANTINE = "quarantine"


class BatchRejected(Exception):
    """A row of an atomic batch was rejected, so nothing was stored."""

    def __init__(self, table: str, seq: int, reason: str, message: str):
        super().__init__(message)
        self.table, self.seq, self.reason, self.message = table, seq, reason, message


@dataclass(frozen=True)
class BatchResult:
    """``contracts`` is the result of contracts that came with a batch of sales."""

    accepted: DataFrame
    rejected: DataFrame
    contracts: BatchResult | None = None


def apply_batch(
    store: SnapshotStore,
    name: str,
    batch: DataFrame,
    mode: str = ATOMIC,
    scope: Sequence[str] = ("date_contract",),
    stream_batch: tuple[str, int] | None = None,
    hot_rows: int | None = None,
    contracts: DataFrame | None = None,
) -> BatchResult:
    """Judge a batch, store its accepted rows and what they entail, as one version.

    ``atomic``: a reject fails the batch with the first one's message, nothing is stored.
    ``quarantine``: the accepted rows are stored, the others returned with their reasons.

    ``contracts`` may arrive between the rows of a batch of sales, in one order of ``seq``: a
    contract that is stored reopens its house for the sales after it, and the last of a
    property's sales and contracts leaves its status.
    """
    if mode not in (ATOMIC, QUARANTINE):
        raise ValueError(f"unknown mode {mode!r}")
    if contracts is not None and name != "transactions":
        raise ValueError("contracts arrive with sales only")
    tables = store.tables()
    results: dict[str, BatchResult] = {}
    with store.one_change(), scratch_scope(store.spark):
        opened = None
        if name == "contracts_owner" or contracts is not None:
            given, others = (batch, None) if contracts is None else (contracts, batch)
            judged = judge("contracts_owner", given, tables, scope, hot_rows, others=others)
            found = store.add_judged("contracts_owner", judged)
            results["contracts_owner"] = BatchResult(*found)
            # Sales are dated by them, and they leave a status.
            opened = cut_lineage(openings(tables.state("status", found[0]), found[0]), "openings")
        if name != "contracts_owner":
            judged = judge(name, batch, tables, scope, hot_rows, others=contracts, openings=opened)
            results[name] = BatchResult(*store.add_judged(name, judged))
        if mode == ATOMIC:
            _refuse_rejects(results)
        if name in ("transactions", "contracts_owner"):
            _store_effects(store, results, opened)
        store.note(stream_batch=stream_batch)
    result = results[name]
    return BatchResult(result.accepted, result.rejected, results.get("contracts_owner") if contracts is not None else None)


def _refuse_rejects(results: Mapping[str, BatchResult]) -> None:
    first = []
    for name, result in results.items():
        row = result.rejected.orderBy("seq").limit(1).collect()
        first += [(name, r.seq, r.reasons[0], r.message) for r in row]
    if first:
        # Rows without a number come first.
        raise BatchRejected(*min(first, key=lambda f: (f[1] is not None, f[1])))


def _store_effects(store: SnapshotStore, results: Mapping[str, BatchResult], opened: DataFrame | None) -> None:
    """The log of accepted sales, and the status that sales and contracts leave."""
    sales = results["transactions"].accepted if "transactions" in results else None
    if sales is not None:
        start = store.version.last_log_id
        stored = sales.count()
        if stored:
            store.add("log_transactions", audit_log(sales, last_id=start))
            store.note(last_log_id=start + stored)
    if opened is None:
        opened = sales.select("property_ID", "seq").limit(0)
    elif sales is None:
        sales = opened.limit(0)
    store.set_status(changed_status(sales, opened))


def store_changes(store: SnapshotStore, changed: Mapping[str, DataFrame]) -> None:
    """Make tables changed by a delete or a renumbering current, all in one version."""
    # All are read before the first is replaced.
    with store.one_change():
        for name, rows in changed.items():
            store.replace(name, rows)


# Rules that read other tables than those a table refers to.
_RULES = {"appointments": ("contracts_owner",), "transactions": ("contracts_owner",), "reviews": ("transactions",)}


def load_steps(names: Iterable[str]) -> list[list[str]]:
    """The tables of a load in steps: each after all that its references and rules read."""
    steps: dict[str, int] = {}
    for name in LOAD_ORDER:
        read = (*[r.parent for r in TABLES[name].references], *_RULES.get(name, ()))
        steps[name] = 1 + max((steps[other] for other in read), default=0)
    wanted = set(names)
    return [[n for n in LOAD_ORDER if steps[n] == step and n in wanted] for step in sorted(set(steps.values()))]


def load_all(
    store: SnapshotStore, batches: Mapping[str, DataFrame], mode: str = ATOMIC
) -> dict[str, BatchResult]:
    """Load one batch per table, every table after the ones it refers to, as one version.

    Each batch is judged against what was stored and what the load has stored before it;
    tables that do not depend on one another are loaded side by side.  If one of them fails,
    nothing of the load is stored.
    """
    results: dict[str, BatchResult] = {}
    with store.one_change(), ThreadPoolExecutor(max(map(len, load_steps(TABLES)))) as pool:
        for step in load_steps(batches):
            running = {name: pool.submit(apply_batch, store, name, batches[name], mode) for name in step}
            wait(running.values())
            results |= {name: done.result() for name, done in running.items()}
    return {name: results[name] for name in LOAD_ORDER if name in results}


def reload_all(
    store: SnapshotStore, batches: Mapping[str, DataFrame], mode: str = ATOMIC
) -> dict[str, BatchResult]:
    """Load all tables anew in place of what they hold, as one version.

    If the load fails, the tables keep their rows.
    """
    with store.one_change():
        store.clear()
        return load_all(store, batches, mode)
