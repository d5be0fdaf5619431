"""A batch judged against the declared constraints and the rules of its table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedflow.operators import effects, gates
from deedflow.operators.quality import as_stored, stated_checks, value_checks
from deedflow.plans import conflicts
from deedflow.plans.reports import Tables
from deedflow.session import cut_lineage
from deedflow.sources.literals import fill_columns
from deedflow.sources.schema import TABLES, Table


# What reopened the property last before a sale, in a batch with contracts.
EPOCH = "_epoch"
# The values of so many rows are sent to all tasks that read stored keys.
SMALL_BATCH = 20_000
# Where there are more repeated values than this part of the rows, rows that share none are not told apart.
MANY = 1 / 8
# What a stored value is to the column of a batch.
OWN, PARENT = 1, 2


def judge(
    name: str,
    batch: DataFrame,
    tables: Tables,
    scope: Sequence[str] = ("date_contract",),
    hot_rows: int | None = None,
    others: DataFrame | None = None,
    openings: DataFrame | None = None,
) -> DataFrame:
    """The batch with ``accepted``, ``reasons``, ``message`` and, if rejected, ``offered``.

    Each row is judged against the stored tables and the accepted rows before it in
    ``seq`` order.  ``reasons`` lists the gate's reason first, ``offered`` holds the row
    as it came in, as JSON.

    Names are matched without regard to case.  ``seq`` gives the order, so a row without a
    whole number there, or with the number of another row, is rejected.

    The result is that of rows stored one after the other: a row that is rejected, for
    whatever reason, holds no key and bars nothing.

    ``others`` are rows of another table that arrive between these and share their numbers.
    ``openings`` (property_ID, seq) are stored contracts among them that put a property up
    for sale again.
    """
    table = getattr(tables, "specs", TABLES)[name]
    batch = fill_columns(batch, {f.name: f.type for f in table.fields})
    checks, stated = value_checks(batch, table), stated_checks(table)
    checks["type:seq"] = F.col("seq").try_cast("long").isNull()
    bits = _bits([*checks, *stated, *_looked_up(table)])
    typed = _typed(table, batch, checks, bits)
    typed = typed.withColumn("_failed", F.col("_failed").bitwiseOR(_failed(stated, bits)))
    if openings is not None:
        typed = gates.with_epochs(typed, openings, EPOCH, hot_rows=hot_rows)
    # Everything below reads the batch from here.
    typed = cut_lineage(typed, f"typed-{name}")
    exceptions = _exceptions(table, typed, tables, others)
    # As many as the table has keys and references.
    present = {row.reason for row in exceptions.select("reason").distinct().collect()}
    rows = _mark(typed, table, exceptions, bits, present).withColumn("_storable", F.col("_failed") == 0)
    options = {"counted": typed, "hot_rows": hot_rows}
    repeated = [key for key in (table.key, *table.unique) if f"repeated:{key}" in present]
    if repeated:
        rows = _settled(name, table, rows, repeated, exceptions, tables, scope, options, bits)
    rows = _gate(name, rows, tables, scope, options)

    accepted = (F.col("_failed") == 0) & F.col("reject").isNull()
    failed = [F.when(F.col("_failed").bitwiseAND(bit) != 0, reason) for reason, bit in bits.items()]
    reasons = F.array_compact(F.array("reject", *failed))
    offered = F.coalesce("offered", F.to_json(F.struct(*table.columns)))
    # Passing rows, nearly all, are spared the lists and texts.
    return rows.select(
        *table.columns,
        "seq",
        F.when(accepted, F.array().cast("array<string>")).otherwise(reasons).alias("reasons"),
        F.when(F.col("reject").isNotNull(), _message(name))
        .when(~accepted, reasons[0])
        .alias("message"),
        F.when(~accepted, offered).alias("offered"),
        accepted.alias("accepted"),
    )


def judge_mixed(
    sales: DataFrame,
    contracts: DataFrame,
    tables: Tables,
    scope: Sequence[str] = ("date_contract",),
    hot_rows: int | None = None,
) -> dict[str, DataFrame]:
    """Sales and contracts that arrive mixed, in one order of ``seq``, each judged by :func:`judge`.

    No sale decides on a contract, so contracts go first; those that are stored reopen
    houses for the sales after them.  A number used in both tables rejects all its rows.
    """
    contracts_judged = judge("contracts_owner", contracts, tables, scope, hot_rows, others=sales)
    contracts_judged = cut_lineage(contracts_judged, "judged-contracts")
    opened = effects.openings(tables["properties"], contracts_judged.filter("accepted"))
    judged = judge("transactions", sales, tables, scope, hot_rows, others=contracts, openings=opened)
    return {"contracts_owner": contracts_judged, "transactions": judged}


def _looked_up(table: Table) -> dict[str, str]:
    """Reasons that need a look at other rows, with the column looked at."""
    orphans = {f"orphan:{r.column}": r.column for r in table.references}
    return orphans | {f"duplicate:{key}": key for key in (table.key, *table.unique, "seq")}


def _bits(reasons: list[str]) -> dict[str, int]:
    """One bit per reason: a row carries its failed checks as one number."""
    return {reason: 1 << i for i, reason in enumerate(reasons)}


def _failed(checks: dict[str, Column], bits: dict[str, int]) -> Column:
    marks = [F.when(c, F.lit(bits[r]).cast("long")).otherwise(0) for r, c in checks.items()]
    return reduce(Column.bitwiseOR, marks, F.lit(0).cast("long"))


def _typed(
    table: Table, batch: DataFrame, checks: dict[str, Column], bits: dict[str, int]
) -> DataFrame:
    """Typed columns, the checks that values failed, and the row if it did not fit."""
    misfits = [failed for reason, failed in checks.items() if reason.startswith("type:") and reason != "type:seq"]
    return batch.select(
        *[as_stored(f.name, batch.schema[f.name].dataType, f.type).alias(f.name) for f in table.fields],
        F.col("seq").try_cast("long").alias("seq"),
        _failed(checks, bits).alias("_failed"),
        F.when(reduce(Column.__or__, misfits, F.lit(False)), F.to_json(F.struct(*table.columns))).alias("offered"),
    )


def _exceptions(table: Table, rows: DataFrame, tables: Tables, others: DataFrame | None = None) -> DataFrame:
    """Values that break a reference, are stored already, or occur in several rows.

    They are few as a rule, so they are looked for among the distinct values and written
    to a table of their own.  Spark then knows its size when it joins the rows with it.
    The values of all columns, and the stored keys under the columns they stand for, go
    through one shuffle as pairs of column and value and are counted there.  Of a small
    batch the pairs are sent to the stored keys first, so that those are not shuffled.
    """
    keys = [table.key, *table.unique]
    references = [r.column for r in table.references]
    columns = list(dict.fromkeys(("seq", *keys, *references)))

    def pair(column: str, value: Column, copies: int = 1, held: int = 0) -> Column:
        return F.struct(
            F.lit(columns.index(column)).cast("byte").alias("column"), value.cast("string").alias("value"),
            F.lit(copies).alias("copies"), F.lit(held).alias("held"),
        )

    pairs = rows.select(F.inline(F.array(*[pair(c, F.col(c)) for c in columns])))
    if others is not None:
        pairs = pairs.unionAll(others.select(F.inline(F.array(pair("seq", F.col("seq").try_cast("long"))))))
    stored = [tables[table.name].select(F.inline(F.array(*[pair(key, F.col(key), 0, OWN) for key in keys])))]
    for r in table.references:
        stored.append(tables[r.parent].select(F.inline(F.array(pair(r.column, F.col(TABLES[r.parent].key), 0, PARENT)))))
    known = reduce(DataFrame.unionAll, stored).filter("value IS NOT NULL")
    pairs = pairs.filter("value IS NOT NULL")
    if rows.count() <= SMALL_BATCH:
        known = known.join(F.broadcast(pairs.filter(F.col("column") > 0).select("column", "value").distinct()), ["column", "value"], "left_semi")
    found = pairs.unionAll(known).groupBy("column", "value").agg(F.sum("copies").alias("copies"), F.bit_or("held").alias("held"))

    def of(names: list[str]) -> Column:
        return F.col("column").isin([columns.index(name) for name in names])

    repeated = F.col("copies") > 1
    kinds = {
        "orphan": of(references) & (F.col("held").bitwiseAND(PARENT) == 0),
        "duplicate": (of(keys) & (F.col("held").bitwiseAND(OWN) != 0)) | (of(["seq"]) & repeated),
        "repeated": of(keys) & repeated,
    }
    found = found.filter("copies > 0").filter(reduce(Column.__or__, kinds.values()))
    kinds = F.array(*[F.when(condition, kind) for kind, condition in kinds.items()])
    found = found.select("column", "value", F.explode(F.array_compact(kinds)).alias("kind"))
    reason = F.concat("kind", F.lit(":"), F.array(*map(F.lit, columns))[F.col("column")])
    return cut_lineage(found.select(reason.alias("reason"), "value"), f"exceptions-{table.name}")


def _with_reason(exceptions: DataFrame, rows: DataFrame, reason: str, column: str) -> DataFrame:
    kind = rows.schema[column].dataType
    return exceptions.filter(F.col("reason") == reason).select(F.col("value").cast(kind).alias(column))


def _mark(
    rows: DataFrame, table: Table, exceptions: DataFrame, bits: dict[str, int], present: set[str]
) -> DataFrame:
    reasons = {reason: column for reason, column in _looked_up(table).items() if reason in present}
    if not reasons:
        return rows
    for reason, column in reasons.items():
        hits = _with_reason(exceptions, rows, reason, column)
        rows = rows.join(hits.withColumn(f"_{reason}", F.lit(True)), column, "left")
    found = _failed({reason: F.col(f"_{reason}") for reason in reasons}, bits)
    rows = rows.withColumn("_failed", F.col("_failed").bitwiseOR(found))
    return rows.drop(*[f"_{reason}" for reason in reasons])


def _settled(
    name: str,
    table: Table,
    rows: DataFrame,
    keys: Sequence[str],
    exceptions: DataFrame,
    tables: Tables,
    scope: Sequence[str],
    options: dict,
    bits: dict[str, int],
) -> DataFrame:
    """Rows that share a ``repeated`` key, decided as if they came one by one.

    A row loses a key to an earlier stored row only, so whether that one passes the gate
    has to be known.  Of gates that look at the batch itself, the groups of such rows are
    decided with them; ``_storable`` then holds for stored rows only, which lets the gate
    see what the host would have seen.
    """
    group = {"transactions": ("property_ID",), "contracts_owner": tuple(scope)}.get(name, ())
    if EPOCH in rows.columns:
        group = (*group, EPOCH)
    # What the stored tables alone reject: no row of the batch counts as storable.
    alone = _gate(name, rows.withColumn("_storable", F.lit(False)), tables, scope, options)
    alone = alone.withColumn("_storable", (F.col("_failed") == 0) & F.col("reject").isNull())
    alone = cut_lineage(alone.drop("reject"), f"judged-{name}")
    values = exceptions.filter(F.col("reason").isin([f"repeated:{key}" for key in keys]))
    if group or values.count() <= options["counted"].count() * MANY:
        sharing = F.lit(False)
        for key in keys:
            hits = _with_reason(exceptions, rows, f"repeated:{key}", key).withColumn(f"_shared_{key}", F.lit(True))
            alone = alone.join(hits, key, "left")
            sharing |= F.coalesce(f"_shared_{key}", F.lit(False))
        alone = cut_lineage(
            alone.withColumn("_sharing", sharing).drop(*[f"_shared_{key}" for key in keys]), f"sharing-{name}"
        )
    else:
        # Rows that share no key compete with none, so all may be settled.
        alone = alone.withColumn("_sharing", F.lit(True))
    contested = alone.filter("_sharing AND _storable")
    if group:
        known = reduce(Column.__and__, [F.col(c).isNotNull() for c in group])
        groups = cut_lineage(contested.filter(known).select(*group).distinct(), "contested-groups")
        others = alone.filter("NOT _sharing AND _storable").join(groups, list(group), "left_semi")
        contested = contested.unionByName(others.select(contested.columns))
        if name == "transactions":
            kind = F.when(F.col("property_ID").isNull(), conflicts.MUTE).otherwise(conflicts.ALONE)
        else:
            kind = F.when(F.col("exclusivity") == "Yes", conflicts.ALONE).when(
                F.col("exclusivity") == "No", conflicts.SHARED
            )
        contested = contested.withColumn("_kind", F.coalesce(kind, F.lit(conflicts.MUTE)))
    found = conflicts.decided(contested, keys, group)
    if group:
        # Only gates of groups ask what was stored.
        lost = found.filter("NOT _stored").select("seq", F.lit(True).alias("_lost"))
        alone = alone.join(lost, "seq", "left")
        alone = alone.withColumn("_storable", F.col("_storable") & F.col("_lost").isNull())
        alone = cut_lineage(alone.drop("_lost"), f"storable-{name}")
    alone = alone.drop("_sharing")
    for key in keys:
        holders = found.filter(F.col("_stored") & F.col(key).isNotNull()).select(key, F.col("seq").alias("_holder"))
        late = _failed({f"duplicate:{key}": F.col("seq") > F.col("_holder")}, bits)
        alone = alone.join(holders, key, "left")
        alone = alone.withColumn("_failed", F.col("_failed").bitwiseOR(late)).drop("_holder")
    return alone


def _gate(
    name: str, rows: DataFrame, tables: Tables, scope: Sequence[str], options: dict
) -> DataFrame:
    kept = getattr(tables, "state", None)

    def state(log: str) -> DataFrame | None:
        """What the store keeps of the batch's keys, if it keeps it."""
        return kept(log, options["counted"]) if kept else None

    if name == "transactions":
        properties = state("status")
        properties = tables["properties"] if properties is None else properties
        epoch = EPOCH if EPOCH in rows.columns else None
        return gates.sold_gate(rows, properties, storable="_storable", epoch=epoch, **options)
    if name == "appointments":
        days = state("contract_days")
        stored = tables["contracts_owner"] if days is None else None
        return gates.appointment_gate(rows, stored, state=days, **options)
    if name == "reviews":
        sales = state("sales")
        stored = tables["transactions"] if sales is None else None
        return gates.review_gate(rows, stored, state=sales, **options)
    if name == "contracts_owner":
        # Numbers are kept per day, the scope of the rule as it is written.
        counts = state("exclusivity") if tuple(scope) == ("date_contract",) else None
        stored = tables["contracts_owner"] if counts is None else None
        return gates.exclusivity_gate(rows, stored, scope, storable="_storable", state=counts, **options)
    return rows.withColumn("reject", F.lit(None).cast("string"))


def _message(name: str) -> Column:
    if name == "transactions":
        return gates.sold_message()
    if name == "appointments":
        return gates.appointment_message()
    if name == "reviews":
        return gates.review_message()
    if name == "contracts_owner":
        return gates.exclusivity_message()
    return F.lit(None).cast("string")
