"""Snapshots that are taken in chunks while changes arrive.

A table is read in ranges of its key, each at a moment of its own. All that is known of the moment
is a bracket: the feed stood at ``low`` before the range was read and at ``high`` after. Changes up
to ``low`` are in the rows that were read, changes after ``high`` are not, and those in between may
be or not, so they replace what was read. From then on the range is what the table was at ``high``,
and the later changes lead on from there.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from .changes import BEFORE, INSERT, apply_changes

# Fixed value: rows of a chunk.
CHUNK_ROWS = 8192
# Brackets are broadcast, a row for each chunk.
MOST_CHUNKS = 10_000
# The largest key.
_MOST = 2**63 - 1


@dataclass(frozen=True)
class KeyChunks:
    """``count`` ranges of a whole-number key, ``width`` keys each from ``low`` on. The first and the
    last are open to their sides, so keys that come later have a chunk as well."""

    key: str
    low: int
    width: int
    count: int

    def number(self) -> Column:
        """The chunk of a row, by arithmetic alone: no look-up, however many chunks."""
        place = F.floor((F.col(self.key).cast("decimal(20,0)") - F.lit(Decimal(self.low))) / F.lit(Decimal(self.width)))
        return F.least(F.greatest(F.coalesce(place, F.lit(0)), F.lit(0)), F.lit(self.count - 1)).cast("int")

    def between(self, first: int, until: int) -> Column:
        """Rows of the chunks from ``first`` on, before ``until``, as bounds of the key that reach the scan."""
        key = F.col(self.key)
        if first >= min(until, self.count):
            return F.lit(False)
        upper = None if until >= self.count else self.low + until * self.width
        lower = None if first <= 0 else self.low + first * self.width
        if lower is not None and lower > _MOST:
            return F.lit(False)
        inside = F.lit(True) if upper is None or upper > _MOST else key < upper
        if lower is not None:
            return inside & (key >= lower)
        return inside if upper is None else inside | key.isNull()


def key_chunks(table: DataFrame, key: str, rows: int = CHUNK_ROWS, most: int = MOST_CHUNKS) -> KeyChunks:
    """Chunks of about ``rows`` rows if the keys are even, fewer and larger ones beyond ``most``.

    One row reaches the driver. A chunk is no task, so uneven keys make uneven chunks and no more.
    """
    found = table.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("n")).first()
    if found.low is None:
        return KeyChunks(key, 0, 1, 1)
    count = max(1, min(-(-found.n // rows), most))
    width = -(-(found.high - found.low + 1) // count)
    return KeyChunks(key, int(found.low), int(width), int(count))


def chunked_snapshot(snapshot: DataFrame, changes: DataFrame, brackets: DataFrame, chunks: KeyChunks,
                     keys: list[str], order: list[str], seq: str = "seq") -> DataFrame:
    """One feed from a table that was read in chunks and the changes of all that time.

    ``snapshot`` has the rows as they were read, ``brackets`` one row for each chunk with ``chunk``,
    ``low`` and ``high``, ``changes`` full row images with their position ``seq``. The feed has each
    chunk's rows as they were at ``high`` as inserts at that position, and the changes after it.
    Any number of chunks takes one pass over the rows and one over the changes. Only the last change
    of each key within its bracket meets the rows; all later changes stay where they are.
    """
    known = F.broadcast(brackets.select(F.col("chunk").alias("_chunk"), F.col("low").alias("_low"), F.col("high").alias("_high")))
    placed = changes.withColumn("_chunk", chunks.number()).join(known, "_chunk")
    during = placed.filter((F.col(seq) > F.col("_low")) & (F.col(seq) <= F.col("_high")))
    rows = snapshot.columns
    read = apply_changes(snapshot, during.select("op", seq, *rows), keys, [seq, *order])
    first = read.withColumn("_chunk", chunks.number()).join(known, "_chunk").select(
        F.lit(INSERT).alias("op"), F.col("_high").cast(changes.schema[seq].dataType).alias(seq), *rows)
    later = placed.filter(F.col(seq) > F.col("_high")).filter(F.col("op") != BEFORE)
    return first.unionByName(later.select("op", seq, *rows))
