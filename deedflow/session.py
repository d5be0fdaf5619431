"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# The tables that the innermost scope has written, in the running thread.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """Session for tests, the bench and own jobs; a given session works as well."""
    builder = (
        SparkSession.builder.appName("deedflow")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Accepted and rejected rows are written side by side without sorting them apart.
        .config("spark.sql.maxConcurrentOutputFileWriters", "4")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="deedflow-"))
    return context.getCheckpointDir()


def cut_lineage(rows: DataFrame, label: str) -> DataFrame:
    """Write ``rows`` once to the shared folder and go on from the written table.

    Later passes read single columns of it instead of repeating the joins, and a
    lost executor costs a re-read only.
    """
    path = f"{scratch_folder(rows.sparkSession)}/deedflow/{label}-{uuid.uuid4().hex}"
    note_written(path)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def note_written(path: str) -> None:
    """Have the innermost :func:`scratch_scope`, if any, remove ``path`` at its end."""
    paths = _WRITTEN.get()
    if paths is not None:
        paths.append(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that are cut out inside; what is to last is stored before the end."""
    paths: list[str] = []
    outer = _WRITTEN.set(paths)
    try:
        yield
    finally:
        _WRITTEN.reset(outer)
        for path in paths:
            remove_folder(spark, path)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, none if there is no such folder; only the driver looks."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(context._jsc.hadoopConfiguration())
    return [found.getPath().getName() for found in system.listStatus(target)] if system.exists(target) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system that Spark reads it with."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
