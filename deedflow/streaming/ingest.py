"""Rows that arrive as a stream, stored batch by batch under the same rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from deedflow.plans.load import QUARANTINE, apply_batch
from deedflow.sources.store import SnapshotStore


def ingest(
    rows: DataFrame, name: str, store: SnapshotStore, checkpoint: str, keep_versions: int | None = None
) -> DataStreamWriter:
    """Writer that stores the rows of a stream; the caller starts it.

    The stream carries ``seq``.  Rejected rows are found with ``store.rejected(name)``.
    A batch that was stored before a restart is not stored again.  Batches are counted per
    table and stream: a stream is known by the id that its checkpoint keeps, so another
    source, or the same one with a new checkpoint, is another stream.

    With ``keep_versions``, folders and versions older than so many batches are removed as
    often, so that neither grows with the number of batches.
    """

    def store_batch(batch: DataFrame, number: int) -> None:
        metadata = batch.sparkSession.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata")
        stream = f"{name}/{metadata.first().id}"
        if store.version.stream_batches.get(stream, -1) >= number:
            return
        apply_batch(store, name, batch, QUARANTINE, stream_batch=(stream, number))
        if keep_versions and number % keep_versions == keep_versions - 1:
            store.sweep(keep_versions)

    return rows.writeStream.foreachBatch(store_batch).option("checkpointLocation", checkpoint)
