"""Conversations brought into the order ``(s?(ua)+)?`` of roles by the cheapest edits.

An edit keeps a message, reroles it to user or assistant, deletes it, or inserts an empty message of user or assistant.
Of all edits of least cost, the ASCII-least sequence of their initials (the audit) is taken.  It is found by depth-first
branch and bound on an explicit stack: a node is a place between messages and the state of the order there; what is left
costs at least what a relaxed order would (the suffix bounds); a table holds the least cost at which each node was
reached, and a prefix that reaches it no cheaper is dropped; and so is one that cannot beat the incumbent.

Messages are sorted by conversation and turn over all tasks, so that a conversation may lie in several.  One that lies
inside a task and within ``BLOCK_ROWS`` is repaired there.  Of the others each block of messages is searched once for
every state that it may begin and end with, and the blocks' audits are chained; so no task holds more than a block's
messages, however long the conversation is.

A null role or text counts as one space.  Null turns come first, messages of one turn in the order of role and text.  A
null id is an id like any other.  Messages without a word are blank, those with role and text of an earlier one are
duplicates, and those whose last such character ends no sentence are truncated; the first of these faults counts.  An
empty table gives no conversations, and other columns are left alone.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from deedflow.llm.rows import written

# Messages, and characters of text, that are worked on at a time.
BLOCK_ROWS = 1024
BLOCK_CHARACTERS = 1 << 22
# Conversations of one task are told apart by so many leading characters of a text at most.
RANGE_CHARACTERS = 64

# Costs of the edits.
INSERTED, REROLED, DELETED, TRUNCATED = 2, 2, 3, 1
# States: nothing yet, after a system message, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
# Whose turn it is in each state, the state after that, and the role an edit gives.
DUE = ("u", "u", "a", "u")
THEN = (USER, USER, ASSISTANT, USER)
GIVEN = ("user", "user", "assistant", "user")
WHOLE = (START, ASSISTANT)
ADJACENT = ("su", "ua", "au")

FINE, CUT, GONE = range(3)
WHITE = " \t\n\x0b\x0c\r"
FAR = 1 << 60

Message = tuple[str, int]
"""The initial of a role, and FINE, CUT (truncated) or GONE (to be deleted)."""


def suffix_bounds(messages: Sequence[Message], ends: Sequence[int]) -> list[tuple[int, int, int, int]]:
    """For each place and state, what the messages from there on cost at least.

    The relaxed order asks only whose turn it is, also at the end.  A system message may stay where all before it are
    deleted.  Ends at the start, or after a system message, leave nothing but deletions.
    """
    n = len(messages)
    late = [FAR, FAR]
    if ASSISTANT in ends:
        late = [0, INSERTED]
    if USER in ends:
        late = [min(late[0], INSERTED), 0]
    start = min(late[0], 0 if START in ends else FAR)
    system = min(late[0], 0 if SYSTEM in ends else FAR)
    bounds = [(start, system, late[1], late[0])] * (n + 1)
    for i in range(n - 1, -1, -1):
        initial, fault = messages[i]
        direct = [DELETED + late[0], DELETED + late[1]]
        start += DELETED
        if fault != GONE:
            cut = TRUNCATED if fault == CUT else 0
            for turn, due in enumerate("ua"):
                edit = 0 if initial == due else REROLED
                direct[turn] = min(direct[turn], cut + edit + late[1 - turn])
            if initial == "s":
                start = min(start, cut + system)
        late = [min(direct[0], INSERTED + direct[1]), min(direct[1], INSERTED + direct[0])]
        start, system = min(start, late[0]), min(DELETED + system, late[0])
        bounds[i] = (start, system, late[1], late[0])
    return bounds


def _children(messages: Sequence[Message], i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """Edit, next place, next state and cost, in the order of the edits' initials."""
    if i < len(messages):
        initial, fault = messages[i]
        yield "D", i + 1, state, DELETED
    yield "I", i, THEN[state], INSERTED
    if i < len(messages) and fault != GONE:
        cut = TRUNCATED if fault == CUT else 0
        if initial == DUE[state]:
            yield "K", i + 1, THEN[state], cut
        elif initial == "s" and state == START:
            yield "K", i + 1, SYSTEM, cut
        yield "R", i + 1, THEN[state], cut + REROLED


def cheapest(messages: Sequence[Message], begin: int = START, ends: Sequence[int] = WHOLE) -> tuple[int, str] | None:
    """Least cost and its ASCII-least audit from state ``begin`` to one of ``ends``, or None if there is no way."""
    n, bounds = len(messages), suffix_bounds(messages, ends)
    if bounds[0][begin] >= FAR:
        return None
    # A first dive along the bounds gives the cost to beat.
    i, state, limit = 0, begin, 0
    while i < n or state not in ends:
        options = [(cost + bounds[j][s], cost, j, s) for _, j, s, cost in _children(messages, i, state)]
        _, cost, i, state = min(options, key=lambda option: option[0])
        limit += cost
    least = [FAR] * (4 * n + 4)
    incumbent: tuple[int, str] | None = None
    path: list[str] = []
    stack = [(0, begin, 0, 0, "")]
    while stack:
        i, state, cost, depth, edit = stack.pop()
        if cost + bounds[i][state] > limit or least[4 * i + state] <= cost:
            continue
        least[4 * i + state] = cost
        del path[max(depth - 1, 0) :]
        if depth:
            path.append(edit)
        if i == n and state in ends:
            # Paths come in the order of their audits, so from now on only a lower cost will do.
            incumbent, limit = (cost, "".join(path)), cost - 1
            continue
        found = [(j, s, cost + more, depth + 1, e) for e, j, s, more in _children(messages, i, state)]
        stack.extend(reversed(found))
    return incumbent


def repaired(rows: Sequence[tuple[str, str]], audit: str, begin: int = START) -> list[tuple[str, str]]:
    """Role and text of the messages that an audit leaves."""
    out, at, state = [], 0, begin
    for edit in audit:
        if edit == "I":
            out.append((GIVEN[state], ""))
            state = THEN[state]
            continue
        role, text = rows[at]
        at += 1
        if edit == "D":
            continue
        out.append((GIVEN[state] if edit == "R" else role, text))
        state = SYSTEM if edit == "K" and role[:1] == "s" and state == START else THEN[state]
    return out


@dataclass
class Faults:
    """What is wrong with consecutive messages of a conversation."""

    messages: list[Message]
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0


def fingerprint(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def faults(rows: Sequence[tuple[str, str]], seen: Iterable[bytes] = ()) -> Faults:
    """``seen`` holds the fingerprints of earlier messages."""
    found, seen = Faults([]), set(seen)
    before = None
    for role, text in rows:
        key = fingerprint(role, text)
        said = text.rstrip(WHITE)
        if not said:
            found.blank += 1
            fault = GONE
        elif key in seen:
            found.duplicate += 1
            fault = GONE
        elif said[-1] not in ".!?":
            found.truncated += 1
            fault = CUT
        else:
            fault = FINE
        seen.add(key)
        initial = role[:1]
        if before is not None and before + initial not in ADJACENT:
            found.illegal += 1
        before = initial
        found.messages.append((initial, fault))
    return found


MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
TURN = T.StructType([T.StructField("turn", T.LongType()), *MESSAGE.fields])
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REPORT = [*[T.StructField(name, T.LongType()) for name in COUNTS], T.StructField("audit", T.StringType())]


def _piece_schema(kind: T.DataType) -> T.StructType:
    """A conversation repaired in one task (``whole``), or a block of one with its messages as they are."""
    return T.StructType(
        [
            T.StructField("conv_id", kind),
            T.StructField("block", T.LongType()),
            T.StructField("whole", T.BooleanType()),
            *REPORT,
            T.StructField("messages", T.ArrayType(MESSAGE)),
            T.StructField("turns", T.ArrayType(TURN)),
            T.StructField("keys", T.ArrayType(T.BinaryType())),
        ]
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in rows], schema=schema)


def _gaps(turns: Sequence[int | None]) -> int:
    given = {t for t in turns if t is not None}
    return max(given) - min(given) + 1 - len(given) if given else 0


def _pairs(rows: Sequence[tuple]) -> list[tuple[str, str]]:
    return [(role, text) for _, role, text in rows]


def _as_dicts(pairs: Sequence[tuple[str, str]]) -> list[dict]:
    return [{"role": role, "text": text} for role, text in pairs]


def _whole(conv_id, block: int, rows: Sequence[tuple]) -> tuple:
    pairs = _pairs(rows)
    found = faults(pairs)
    cost, audit = cheapest(found.messages)
    counts = (_gaps([r[0] for r in rows]), found.blank, found.duplicate, found.truncated, found.illegal, cost)
    return (conv_id, block, True, *counts, audit, _as_dicts(repaired(pairs, audit)), None, None)


def _block(conv_id, block: int, rows: Sequence[tuple]) -> tuple:
    turns = [{"turn": t, "role": role, "text": text} for t, role, text in rows]
    keys = list(dict.fromkeys(fingerprint(role, text) for _, role, text in rows))
    return (conv_id, block, False, *[None] * (len(COUNTS) + 1), None, turns, keys)


def _pieces(rows: DataFrame, block_rows: int) -> DataFrame:
    """Sorted messages as repaired conversations, and as blocks of those that no task may hold or see whole."""
    kind = rows.schema["conv_id"].dataType
    schema = _piece_schema(kind)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        arrow = to_arrow_schema(schema)
        number = TaskContext.get().partitionId() << 32
        out: list[tuple] = []
        held: list[tuple] = []
        # The first conversation may have begun in the task before.
        conv_id, size, split, started = None, 0, True, False
        for batch in batches:
            for of, *row in zip(*(column.to_pylist() for column in batch.columns)):
                new = not started or of != conv_id
                if held and (new or len(held) >= block_rows or size >= BLOCK_CHARACTERS):
                    split |= not new
                    out.append((_block if split else _whole)(conv_id, number, held))
                    number, held, size = number + 1, [], 0
                if new:
                    split, conv_id, started = not started, of, True
                held.append(tuple(row))
                size += len(row[2])
                if len(out) >= 500:
                    yield _batch(out, arrow)
                    out = []
        if held:
            # The last one may go on in the next task.
            out.append(_block(conv_id, number, held))
        if out:
            yield _batch(out, arrow)

    return rows.mapInArrow(cut, schema)


PATH = T.StructType(
    [
        T.StructField("begin", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("cost", T.LongType()),
        T.StructField("audit", T.StringType()),
    ]
)
SUMMARY = [
    *[T.StructField(name, T.LongType()) for name in ("blank", "duplicate", "truncated", "illegal", "turns", "least", "most")],
    T.StructField("first", T.StringType()),
    T.StructField("last", T.StringType()),
    T.StructField("paths", T.ArrayType(PATH)),
]


def _summaries(blocks: DataFrame) -> DataFrame:
    """Each block's faults and its cheapest audits between all states; ``seen`` are the keys of earlier blocks."""
    kind = blocks.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("block", T.LongType()), *SUMMARY])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for row in range(batch.num_rows):
                conv_id, block, turns, seen = (column[row].as_py() for column in batch.columns)
                found = faults([(t["role"], t["text"]) for t in turns], seen or ())
                given = {t["turn"] for t in turns if t["turn"] is not None}
                ways = [(b, e, cheapest(found.messages, b, (e,))) for b in STATES for e in STATES]
                paths = [{"begin": b, "end": e, "cost": w[0], "audit": w[1]} for b, e, w in ways if w]
                counts = (found.blank, found.duplicate, found.truncated, found.illegal)
                reach = (len(given), min(given, default=None), max(given, default=None))
                ends = (found.messages[0][0], found.messages[-1][0])
                yield _batch([(conv_id, block, *counts, *reach, *ends, paths)], arrow)

    return blocks.select("conv_id", "block", "turns", "seen").mapInArrow(summarise, schema)


class Chain:
    """Blocks of one conversation put together in order."""

    def __init__(self) -> None:
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.turns, self.least, self.most, self.last = 0, None, None, None
        self.settled: list[str] = []
        self.best: dict[int, tuple[int, str]] = {START: (0, "")}
        # For each block, its number and from where each state was reached.
        self.steps: list[tuple[int, dict[int, int]]] = []

    def add(self, block: int, row: dict) -> None:
        for name in self.counts:
            self.counts[name] += row[name]
        if self.last is not None and self.last + row["first"] not in ADJACENT:
            self.counts["illegal"] += 1
        self.last = row["last"]
        if row["turns"]:
            # A turn may lie on both sides of the cut.
            self.turns += row["turns"] - (self.most == row["least"])
            self.least = row["least"] if self.least is None else self.least
            self.most = row["most"]
        reached: dict[int, tuple[int, str, int]] = {}
        for path in row["paths"]:
            if path["begin"] in self.best:
                cost, audit = self.best[path["begin"]]
                way = (cost + path["cost"], audit + path["audit"], path["begin"])
                reached[path["end"]] = min(way, reached.get(path["end"], way))
        # What all audits begin with is settled.
        common = os.path.commonprefix([audit for _, audit, _ in reached.values()])
        self.settled.append(common)
        self.best = {end: (cost, audit[len(common) :]) for end, (cost, audit, _) in reached.items()}
        self.steps.append((block, {end: begin for end, (_, _, begin) in reached.items()}))

    def report(self) -> tuple:
        cost, audit, state = min((*self.best[end], end) for end in WHOLE if end in self.best)
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        self.ways = []
        for block, begins in reversed(self.steps):
            self.ways.append({"block": block, "begin": begins[state], "end": state})
            state = begins[state]
        return (gaps, *self.counts.values(), cost, "".join([*self.settled, audit]), self.ways[::-1])


def _chained(summaries: DataFrame) -> DataFrame:
    """One row per conversation: its report, and between which states each of its blocks lies."""
    kind = summaries.schema["conv_id"].dataType
    way = T.StructType([T.StructField("block", T.LongType()), T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([T.StructField("conv_id", kind), *REPORT, T.StructField("ways", T.ArrayType(way))])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        conv_id, held = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if held is None or row["conv_id"] != conv_id:
                    if held is not None:
                        yield _batch([(conv_id, *held.report())], arrow)
                    conv_id, held = row["conv_id"], Chain()
                held.add(row["block"], row)
        if held is not None:
            yield _batch([(conv_id, *held.report())], arrow)

    ordered = summaries.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return ordered.mapInArrow(chain, schema)


def _repaired_blocks(blocks: DataFrame) -> DataFrame:
    """The messages that the chosen way through each block leaves."""
    kind = blocks.schema["conv_id"].dataType
    schema = T.StructType(
        [T.StructField("conv_id", kind), T.StructField("block", T.LongType()), T.StructField("messages", T.ArrayType(MESSAGE))]
    )

    def repair_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for row in range(batch.num_rows):
                conv_id, block, turns, begin, audit = (column[row].as_py() for column in batch.columns)
                left = repaired([(t["role"], t["text"]) for t in turns], audit, begin)
                yield _batch([(conv_id, block, _as_dicts(left))], arrow)

    return blocks.select("conv_id", "block", "turns", "begin", "audit").mapInArrow(repair_block, schema)


@dataclass(frozen=True)
class Repair:
    """``reports``: a row per conversation with its counts, cost and audit.

    ``messages``: what is left, in rows of bounded size by ``conv_id`` and ``block``; ``whole`` marks conversations that
    are in one row.
    """

    reports: DataFrame
    messages: DataFrame


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> Repair:
    """Repair the conversations of ``rows`` (conv_id, turn, role, text)."""
    filled = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    # Longer texts that begin alike lie in one task, in the same order.
    ranged = filled.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, RANGE_CHARACTERS))
    ordered = ranged.sortWithinPartitions("conv_id", "turn", "role", "text")
    pieces = written(_pieces(ordered, block_rows), "repair-pieces")
    whole = pieces.filter("whole")
    blocks = pieces.filter("NOT whole").select("conv_id", "block", "turns", "keys")

    # Numbers of blocks differ between tasks, so they name blocks by themselves.
    keys = blocks.select("conv_id", "block", F.explode("keys").alias("key"))
    first = keys.groupBy("conv_id", "key").agg(F.min("block").alias("_first"), F.count(F.lit(1)).alias("_blocks"))
    first = written(first.filter("_blocks > 1").drop("_blocks"), "repair-repeats")
    same = F.expr("a.conv_id <=> b.conv_id AND a.key = b.key AND a.block > b._first")
    seen = keys.alias("a").join(first.alias("b"), same).groupBy("a.block").agg(F.collect_list("a.key").alias("seen"))
    summaries = written(_summaries(blocks.join(seen, "block", "left")), "repair-summaries")
    chained = written(_chained(summaries), "repair-chains")

    ways = chained.select(F.explode("ways").alias("way")).select("way.*")
    paths = summaries.select("block", F.explode("paths").alias("path")).select("block", "path.begin", "path.end", "path.audit")
    chosen = paths.join(ways, ["block", "begin", "end"])
    left = _repaired_blocks(blocks.join(chosen, "block"))
    names = ["conv_id", *COUNTS, "audit"]
    columns = ["conv_id", "block", "messages"]
    return Repair(
        whole.select(names).unionAll(chained.select(names)),
        whole.select(*columns, F.lit(True).alias("whole")).unionAll(left.select(*columns, F.lit(False).alias("whole"))),
    )


def digests(messages: DataFrame) -> DataFrame:
    """``conv_id`` and ``repaired_sha256`` of the repaired ``role:text`` lines.

    A checksum is taken in order, so the blocks of one conversation pass through one task, a batch at a time.
    """
    kind = messages.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), T.StructField("repaired_sha256", T.StringType())])
    lines = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    whole = messages.filter("whole").select("conv_id", F.sha2(lines, 256).alias("repaired_sha256"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        conv_id, held, begun = None, None, False
        for batch in batches:
            for of, text, n in zip(*(column.to_pylist() for column in batch.columns)):
                if held is None or of != conv_id:
                    if held is not None:
                        yield _batch([(conv_id, held.hexdigest())], arrow)
                    conv_id, held, begun = of, hashlib.sha256(), False
                if n:
                    held.update((("\n" if begun else "") + text).encode())
                    begun = True
        if held is not None:
            yield _batch([(conv_id, held.hexdigest())], arrow)

    blocks = messages.filter("NOT whole").select("conv_id", "block", lines.alias("lines"), F.size("messages").alias("n"))
    blocks = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block").select("conv_id", "lines", "n")
    return whole.unionAll(blocks.mapInArrow(digest, schema))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with faults dealt by a checksum of ``conv_id:turn``; nulls become one space."""

    def text_of(column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(text_of("text"), ".!?", "")).otherwise(text_of("text"))
    copies = F.when(fault == 0, F.array().cast("array<int>")).when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    kept = rows.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(text_of("role")).alias("role"), text.alias("text"), copies.alias("copies")
    )
    return kept.select("conv_id", "turn", "role", "text", F.explode("copies")).drop("col")
