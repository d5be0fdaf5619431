"""Parquet snapshots of the tables in a shared folder, with one current version.

Plain Parquet has no UPDATE, so a changed table is written to a new folder; status changes are appended to a log of
their own and looked up when the table is read.  A version maps each table to its folders and is written last, in one
small file: readers see all of a change or nothing of it.  There is one writer at a time.

Folders of many small batches are brought together as they come: ``MERGED`` folders of one level become one of the
next, so that a table of any number of batches is read from few folders and a row is rewritten once per level.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deedflow.session import folder_names, remove_folder
from deedflow.sources.schema import ID_DIGITS, TABLES, Table, clear_order, tables_with
from deedflow.sources.state import BUCKET, BUCKETS, LOGS, StateLog, bucket_of, logs_of
from deedflow.sources.tables import LazyTables

STATUS = "prop_status"
# So many folders of one level are brought together in one of the next.
MERGED = 16

# What judging a batch adds to the table's own columns.
VERDICT = {
    "seq": T.LongType(),
    "reasons": T.ArrayType(T.StringType()),
    "message": T.StringType(),
    "offered": T.StringType(),
}


def rejected_schema(table: Table) -> T.StructType:
    return T.StructType([*table.schema.fields, *[T.StructField(c, t, True) for c, t in VERDICT.items()]])


def accepted_schema(table: Table) -> T.StructType:
    return T.StructType([*table.schema.fields, T.StructField("seq", T.LongType())])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, which the optimizer knows, so that joins with them cost nothing."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*nothing).filter(F.lit(False))


@dataclass(frozen=True)
class Run:
    """A folder below the store's root.  ``buckets`` are those of a state log that it has; ``changes`` marks rows that
    differ from what their table says."""

    path: str
    level: int = 0
    buckets: tuple[int, ...] = ()
    changes: bool = False


Runs = dict[str, tuple[Run, ...]]


@dataclass(frozen=True)
class Version:
    number: int = 0
    # Declared width of the ids, and the tables' types with it.
    id_digits: int = ID_DIGITS
    # Into so many folders what is kept of keys is dealt.
    buckets: int = BUCKETS
    schemas: dict[str, str] = field(default_factory=dict)
    folders: Runs = field(default_factory=dict)
    # Rows that quarantined batches left out.
    rejected: Runs = field(default_factory=dict)
    logs: Runs = field(default_factory=dict)
    # Changes made so far, which tells the last status of a property.
    steps: int = 0
    last_log_id: int = 0
    # Last batch stored per table and stream.
    stream_batches: dict[str, int] = field(default_factory=dict)

    def paths(self) -> set[str]:
        return {run.path for runs in (self.folders, self.rejected, self.logs) for some in runs.values() for run in some}

    def to_json(self) -> str:
        return json.dumps(self, default=vars)

    @staticmethod
    def from_json(content: str) -> Version:
        kept = json.loads(content)
        for name in ("folders", "rejected", "logs"):
            kept[name] = {
                key: tuple(Run(**run | {"buckets": tuple(run["buckets"])}) for run in runs) for key, runs in kept[name].items()
            }
        return Version(**kept)


class SchemaMismatch(Exception):
    """A store was written with other types than the ones it is opened with."""


def _schemas(specs: dict[str, Table]) -> dict[str, str]:
    return {name: spec.schema.simpleString() for name, spec in specs.items()}


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, id_digits: int | None = None, buckets: int = BUCKETS):
        """Open the store in the folder ``root``, or make a new one.

        A new store's ids have up to ``id_digits`` digits, and what it keeps of keys is dealt into ``buckets`` folders:
        a batch of few keys reads few of them, so large stores take more.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        # Folders written by a change that is still going on; its parts may be written side by side.
        self._written: list[str] | None = None
        self._lock = threading.RLock()
        number = self._numbers()[-1:]
        if number:
            self.version = self._load(number[0])
            if id_digits not in (None, self.version.id_digits):
                raise SchemaMismatch(f"the ids of this store have {self.version.id_digits} digits; widen() changes that")
            if self.version.schemas != _schemas(self.specs):
                raise SchemaMismatch("the store was written with other types than those declared now")
        else:
            digits = ID_DIGITS if id_digits is None else id_digits
            self.version = Version(id_digits=digits, buckets=buckets, schemas=_schemas(tables_with(digits)))

    @property
    def specs(self) -> dict[str, Table]:
        return tables_with(self.version.id_digits)

    # Versions

    def _numbers(self) -> list[int]:
        """Of the versions whose one file is there, in order."""
        base = f"{self.root}/versions"
        numbers = sorted(int(name) for name in folder_names(self.spark, base) if name.isdigit())
        while numbers and not any(name.endswith(".json") for name in folder_names(self.spark, f"{base}/{numbers[-1]:09d}")):
            numbers.pop()
        return numbers

    def _load(self, number: int) -> Version:
        file = self.spark.read.schema("content string").json(f"{self.root}/versions/{number:09d}")
        return Version.from_json(file.first().content)

    def _publish(self, version: Version) -> None:
        content = self.spark.range(1, numPartitions=1).select(F.lit(version.to_json()).alias("content"))
        content.write.json(f"{self.root}/versions/{version.number:09d}")

    @contextmanager
    def one_change(self) -> Iterator[None]:
        """Make all that is stored inside current as one version at the end.

        An error leaves the version as it was and removes what was written.  Inside, this store reads its own changes;
        others see none of them before the end.  Changes inside a change are part of it.
        """
        if self._written is not None:
            yield
            return
        before, self._written = self.version, []
        try:
            yield
            self._merge_full_levels()
            if self.version != before:
                self.version = replace(self.version, number=before.number + 1)
                self._publish(self.version)
        except BaseException:
            self.version = before
            for path in self._written:
                remove_folder(self.spark, f"{self.root}/{path}")
            raise
        finally:
            self._written = None

    # Reading

    def _read(self, schema: T.StructType, paths: list[str]) -> DataFrame:
        if not paths:
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{path}" for path in paths])

    def table(self, name: str, version: Version | None = None) -> DataFrame:
        """The rows of a table, as of the current version if none is given."""
        version = version or self.version
        spec = tables_with(version.id_digits)[name]
        rows = self._read(spec.schema, [run.path for run in version.folders.get(name, ())])
        if name == "properties" and any(run.changes for run in version.logs.get("status", ())):
            last = self.state("status", version=version, changes_only=True)
            last = last.select(spec.key, F.col(STATUS).alias("_status"))
            columns = [F.coalesce("_status", STATUS).alias(c) if c == STATUS else F.col(c) for c in spec.columns]
            rows = rows.join(last, spec.key, "left").select(*columns)
        return rows

    def state(
        self, log: str, keys: DataFrame | None = None, version: Version | None = None, changes_only: bool = False
    ) -> DataFrame:
        """What is kept of each key; with ``keys``, only the buckets that these keys are in are read."""
        version = version or self.version
        kept = LOGS[log]
        wanted = None
        if keys is not None:
            bucket = bucket_of(kept.key, version.buckets).alias(BUCKET)
            # As many as there are buckets.
            found = keys.filter(F.col(kept.key).isNotNull()).select(bucket).distinct()
            wanted = {row[0] for row in found.collect()}
        runs = [run for run in version.logs.get(log, ()) if run.changes or not changes_only]
        return kept.fold(self._read(kept.schema(self._spec_of(kept, version)), self._bucket_paths(runs, wanted)))

    def _spec_of(self, log: StateLog, version: Version) -> Table:
        return tables_with(version.id_digits)[log.table]

    @staticmethod
    def _bucket_paths(runs: list[Run], wanted: set[int] | None = None) -> list[str]:
        return [f"{run.path}/{BUCKET}={b}" for run in runs for b in run.buckets if wanted is None or b in wanted]

    def rejected(self, name: str) -> DataFrame:
        """The rows that quarantined batches of a table left out, with their reasons."""
        return self._read(rejected_schema(self.specs[name]), [run.path for run in self.version.rejected.get(name, ())])

    def tables(self) -> LazyTables:
        """All tables as of the current version, also if read after a later one."""
        version = self.version
        return LazyTables(
            lambda name: self.table(name, version),
            tables_with(version.id_digits),
            lambda log, keys: self.state(log, keys, version),
        )

    # Writing

    def _new_folder(self, name: str) -> str:
        path = f"{name}/batch={uuid.uuid4().hex}"
        if self._written is not None:
            self._written.append(path)
        return path

    def _amend(self, change: Callable[[Version], dict]) -> None:
        with self._lock:
            self.version = replace(self.version, **change(self.version))

    def _with_run(self, kind: str, name: str, run: Run | None) -> None:
        if run:
            self._amend(lambda v: {kind: getattr(v, kind) | {name: (*getattr(v, kind).get(name, ()), run)}})

    def _write(self, name: str, rows: DataFrame, level: int = 0) -> Run:
        path = self._new_folder(name)
        rows.write.parquet(f"{self.root}/{path}")
        return Run(path, level)

    def _write_log(self, log: str, rows: DataFrame, level: int = 0, changes: bool = False) -> Run | None:
        path = self._new_folder(f"{log}_state")
        dealt = rows.withColumn(BUCKET, bucket_of(LOGS[log].key, self.version.buckets)).repartition(BUCKET)
        dealt.write.partitionBy(BUCKET).parquet(f"{self.root}/{path}")
        names = folder_names(self.spark, f"{self.root}/{path}")
        buckets = sorted(int(name.split("=")[1]) for name in names if name.startswith(f"{BUCKET}="))
        return Run(path, level, tuple(buckets), changes) if buckets else None

    def _keep_state(self, name: str, rows: DataFrame) -> None:
        for log in logs_of(name):
            self._with_run("logs", log.name, self._write_log(log.name, log.taken(rows, self.version.steps)))

    def _next_step(self) -> None:
        self._amend(lambda v: {"steps": v.steps + 1})

    def add_judged(self, name: str, judged: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Store a judged batch; returns its accepted rows with ``seq``, and the rejected ones with their reasons."""
        spec = self.specs[name]
        with self.one_change():
            self._next_step()
            path = self._new_folder(name)
            judged.write.partitionBy("accepted").parquet(f"{self.root}/{path}")
            names = folder_names(self.spark, f"{self.root}/{path}")
            kept, left = ([f"{path}/accepted={x}"] if f"accepted={x}" in names else [] for x in ("true", "false"))
            accepted = self._read(accepted_schema(spec), kept)
            for some in kept:
                self._with_run("folders", name, Run(some))
                self._keep_state(name, accepted)
            for some in left:
                self._with_run("rejected", name, Run(some))
            return accepted, self._read(rejected_schema(spec), left)

    def add(self, name: str, rows: DataFrame) -> None:
        """Store rows that need no judging."""
        with self.one_change():
            self._next_step()
            run = self._write(name, rows)
            self._with_run("folders", name, run)
            self._keep_state(name, self._read(self.specs[name].schema, [run.path]))

    def set_status(self, changed: DataFrame) -> None:
        """Give properties a new status; ``changed`` holds each ``property_ID`` once with its ``prop_status``."""
        with self.one_change():
            self._next_step()
            number = F.lit(self.version.steps).cast("long").alias("number")
            rows = changed.select("property_ID", F.lit(None).cast("string").alias("property_TYPE"), STATUS, number)
            self._with_run("logs", "status", self._write_log("status", rows, changes=True))

    def replace(self, name: str, rows: DataFrame | None) -> None:
        """Put ``rows``, or none, in place of a table's rows, and of what is kept of their keys."""
        with self.one_change():
            self._next_step()
            run = None if rows is None else self._write(name, rows.select(*self.specs[name].columns))
            gone = {name, *[log.name for log in logs_of(name)]}
            self._amend(lambda v: {kind: {k: runs for k, runs in getattr(v, kind).items() if k not in gone} for kind in ("folders", "logs")})
            if run:
                self._with_run("folders", name, run)
                self._keep_state(name, self._read(self.specs[name].schema, [run.path]))

    def note(self, last_log_id: int | None = None, stream_batch: tuple[str, int] | None = None) -> None:
        with self.one_change():
            if last_log_id is not None:
                self._amend(lambda v: {"last_log_id": last_log_id})
            if stream_batch:
                self._amend(lambda v: {"stream_batches": v.stream_batches | {stream_batch[0]: stream_batch[1]}})

    def clear(self) -> None:
        """Empty every table, children before their parents.

        The counter of the log ids goes on, as deleting rows does not reset it.
        """
        with self.one_change():
            for name in clear_order():
                self.replace(name, None)

    def widen(self, id_digits: int) -> None:
        """Declare wider ids.  Stored rows are read with the wider type, none is rewritten."""
        if id_digits < self.version.id_digits:
            raise SchemaMismatch(f"ids of {self.version.id_digits} digits cannot get {id_digits}")
        with self.one_change():
            self._amend(lambda v: {"id_digits": id_digits, "schemas": _schemas(tables_with(id_digits))})

    # Upkeep

    def _merge_full_levels(self) -> None:
        for kind in ("folders", "rejected", "logs"):
            for name in getattr(self.version, kind):
                level = 0
                while level <= max((run.level for run in getattr(self.version, kind)[name]), default=0):
                    full = [run for run in getattr(self.version, kind)[name] if run.level == level]
                    if len(full) >= MERGED:
                        self._merge(kind, name, full, level + 1)
                    level += 1

    def _merge(self, kind: str, name: str, runs: list[Run], level: int) -> None:
        paths = [run.path for run in runs]
        if kind == "logs":
            log = LOGS[name]
            rows = self._read(log.schema(self._spec_of(log, self.version)), self._bucket_paths(runs))
            merged = self._write_log(name, log.fold(rows), level, any(run.changes for run in runs))
        elif kind == "folders":
            merged = self._write(name, self._read(self.specs[name].schema, paths), level)
        else:
            merged = self._write(name, self._read(rejected_schema(self.specs[name]), paths), level)
        kept = tuple(run for run in getattr(self.version, kind)[name] if run not in runs)
        self._amend(lambda v: {kind: getattr(v, kind) | {name: (*kept, *([merged] if merged else []))}})

    def compact(self, name: str) -> None:
        """Bring all folders of a table together in one, with its status changes, and those of its rejected rows."""
        with self.one_change():
            level = max((run.level for run in self.version.folders.get(name, ())), default=0)
            self.replace(name, self.table(name))
            # It stands for as many batches as before.
            (run,) = self.version.folders[name]
            self._amend(lambda v: {"folders": v.folders | {name: (replace(run, level=level),)}})
            left = list(self.version.rejected.get(name, ()))
            if len(left) > 1:
                self._merge("rejected", name, left, max(run.level for run in left))

    def sweep(self, versions: int = 1) -> int:
        """Remove the folders that the last ``versions`` versions do not name, and older versions; returns how many.

        Those still read by someone need to be among the versions kept.
        """
        if self._written is not None:
            raise ValueError("a change is going on")
        if versions < 1:
            raise ValueError("the current version stays")
        numbers = self._numbers()
        live = set().union(self.version.paths(), *[self._load(n).paths() for n in numbers[-versions:]])
        gone = [f"versions/{n:09d}" for n in numbers[:-versions]]
        for top in folder_names(self.spark, self.root):
            if top == "versions":
                continue
            for batch in folder_names(self.spark, f"{self.root}/{top}"):
                path = f"{top}/{batch}"
                parts = [p for p in live if p.startswith(f"{path}/")]
                if path not in live and not parts:
                    gone.append(path)
                elif parts:
                    inside = [f"{path}/{name}" for name in folder_names(self.spark, f"{self.root}/{path}")]
                    gone.extend(p for p in inside if p not in live and "/accepted=" in p)
        for path in gone:
            remove_folder(self.spark, f"{self.root}/{path}")
        return len(gone)
