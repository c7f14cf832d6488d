"""A snapshot that is taken chunk by chunk between the batches of a running feed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..files import is_dir
from ..operators.changes import INSERT, latest_per_key
from ..operators.snapshots import KeyChunks
from ..sources.sinks import BatchNumber, BatchWriter, batch_folder, stream_of


class SnapshotStream:
    """Reads ``per_batch`` chunks of a table after each batch of its feed, until all are read.

    A stream chooses the end of a batch only when the batch before is done. So chunks that are read
    at the end of batch n are read after the feed's position at the end of n and before that at the
    end of n + 1: batch n + 1 is their bracket. With it they are handed on, its changes replacing
    what was read. Changes of chunks that are not read yet are left out, as the rows will hold them;
    those of chunks handed on before pass. Which chunks a batch takes follows from its number, so a
    batch that is delivered again does the same again.
    """

    def __init__(self, spark: SparkSession, home: str, chunks: KeyChunks, per_batch: int,
                 read: Callable[[int, int], DataFrame], keys: list[str], order: list[str]):
        """``read(first, until)`` gives the table's rows in these chunks, as they are when it is called."""
        self.spark, self.home, self.chunks, self.per_batch = spark, home.rstrip("/"), chunks, per_batch
        self.read, self.keys, self.order = read, keys, order

    def writer(self, write: BatchWriter) -> BatchWriter:
        """A target for the feed's batches that hands changes on to another."""
        def each(changes: DataFrame, batch_id: int) -> None:
            write(self.batch(changes, batch_id), batch_id)
            self.stage(batch_id)
        return each

    def batch(self, changes: DataFrame, batch_id: int) -> DataFrame:
        """What a batch hands on: the chunks that it is the bracket of, and the changes of earlier ones."""
        bracketed = (int(batch_id) - 1) * self.per_batch
        number = self.chunks.number()
        passing = changes.filter(number < bracketed)
        folder = self._folder(int(batch_id) - 1, batch_id)
        if bracketed < 0 or bracketed >= self.chunks.count or not is_dir(self.spark, folder):
            return passing
        fields = [f for f in changes.schema.fields if f.name != "op"]
        read = self.spark.read.schema(changes.select(*[f.name for f in fields]).schema).parquet(folder)
        inside = changes.filter((number >= bracketed) & (number < bracketed + self.per_batch))
        both = read.select(F.lit(INSERT).alias("op"), F.lit(0).alias("_seen"), *read.columns).unionByName(
            inside.withColumn("_seen", F.lit(1)))
        return passing.unionByName(latest_per_key(both, self.keys, ["_seen", *self.order]).select(*changes.columns))

    def stage(self, batch_id: int) -> None:
        """Read the next chunks. A batch that is delivered again reads them anew: the feed has not gone on."""
        first = int(batch_id) * self.per_batch
        if first < self.chunks.count:
            self.read(first, first + self.per_batch).write.mode("overwrite").parquet(self._folder(int(batch_id), batch_id))

    def left(self, batch_id: int) -> DataFrame:
        """For a feed that has ended with this batch: the rows of the chunks that are not handed on."""
        return self.read(int(batch_id) * self.per_batch, self.chunks.count)

    def done(self, batch_id: int) -> bool:
        """Whether this batch hands on, or an earlier one has handed on, the last chunk."""
        return int(batch_id) * self.per_batch >= self.chunks.count

    def _folder(self, number: int, batch_id: int) -> str:
        return batch_folder(f"{self.home}/chunks", BatchNumber(number, stream_of(batch_id)))
