"""Streaming queries: one change stream to many targets, independent jobs per domain."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import files
from ..sources.sinks import BatchNumber, BatchWriter
from .keyed import KeyedTable
from .view import MaintainedView, apply_to_both

# How often jobs commit their progress.
CHECKPOINT_EVERY = {"kafka": "10 seconds", "analytics": "30 seconds", "sync": "60 seconds"}

WATERMARK_POLICY = "spark.sql.streaming.multipleWatermarkPolicy"

# For streams of few large batches that are stopped and started again. Each batch leaves the state's files, so a
# start costs what is open; logs of changes would be replayed from the first batch on, as a snapshot of them is
# only taken now and then. Rows in state are not counted, which would look up each key before it is written.
FEW_LARGE_BATCHES = {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def fan_out(changes: DataFrame, writers: dict[str, BatchWriter], name: str, checkpoint: str,
            prepare: Callable[[DataFrame], DataFrame] = lambda df: df, **trigger) -> StreamingQuery:
    """Read a change stream once and hand each batch to every writer.

    ``prepare`` runs once per batch, before it is cached. When all targets are keyed alike, cut
    the batch to its last change per key there: the cached rows then lie by key already, and
    no writer shuffles them again.

    A batch that fails in one writer is delivered to all of them again, so writers have to
    recognize a batch by its number; those of this library do.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        batch = prepare(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for write in writers.values():
                write(batch, batch_id)
        finally:
            batch.unpersist()

    return for_each_batch(changes, each, name, checkpoint, **trigger)


def for_each_batch(changes: DataFrame, each: BatchWriter, name: str, checkpoint: str,
                   output_mode: str = "append", **trigger) -> StreamingQuery:
    """Hand each batch to a writer, with its number and the stream that the checkpoint names."""
    def numbered(batch: DataFrame, batch_id: int) -> None:
        named = json.loads(files.read_text(batch.sparkSession, f"{checkpoint}/metadata"))
        each(batch, BatchNumber(batch_id, named["id"]))

    return (
        changes.writeStream.queryName(name).outputMode(output_mode).foreachBatch(numbered)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": CHECKPOINT_EVERY["sync"]})).start()
    )


def table_writer(table: KeyedTable, prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
                 compact_every: int = 20) -> BatchWriter:
    """Upsert target. Compacts now and then, so readers have few batches to merge.

    What the last ``compact_every`` versions do not use is deleted then, so a reader may work on
    a version while that many batches arrive.
    """
    def write(changes: DataFrame, batch_id: int) -> None:
        if table.apply(prepare(changes), batch_id) and (batch_id + 1) % compact_every == 0:
            table.table.compact()
            table.table.vacuum(keep_versions=compact_every)
    return write


def view_writer(table: KeyedTable, view: MaintainedView, compact_every: int = 20) -> BatchWriter:
    """Table and view from changes that carry no before-images."""
    def write(changes: DataFrame, batch_id: int) -> None:
        if apply_to_both(changes, batch_id, table, view) and (batch_id + 1) % compact_every == 0:
            for stored in (table.table, view.sums):
                stored.compact()
                stored.vacuum(keep_versions=compact_every)
    return write


def append_to_parquet(df: DataFrame, path: str, name: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Closed windows, or a plain projection, to a folder; each row appears exactly once."""
    return (
        df.writeStream.queryName(name).format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": CHECKPOINT_EVERY["analytics"]})).start()
    )


def with_settings(spark: SparkSession, settings: dict[str, str], start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Start a query under session settings that hold for it alone: it takes them along when it starts."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        return start()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def with_watermark_policy(spark: SparkSession, policy: str, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Start a query over several sources that each carry a watermark.

    With ``min`` the query waits for the slowest source and loses no row to another's haste; with
    ``max`` it goes by the fastest, and what a slower one sends for closed windows is dropped. The
    checkpoint keeps the choice of the first start.
    """
    if policy not in ("min", "max"):
        raise ValueError(f"policy must be 'min' or 'max', not {policy!r}")
    return with_settings(spark, {WATERMARK_POLICY: policy}, start)


def start_domains(starters: dict[str, Callable[[str], StreamingQuery]]) -> dict[str, StreamingQuery]:
    """One query per business domain, so that one can fail or restart without the others."""
    return {domain: start(domain) for domain, start in starters.items()}
