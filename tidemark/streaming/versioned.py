"""A table that takes one batch of changes at a time and keeps its parts by bucket.

Each batch is written next to the table as it comes and costs no more than its own size. Readers
merge the batches with the buckets they touch, and ``compact`` writes those buckets anew. What
belongs to the table is listed in a small numbered manifest; a batch counts from the moment its
manifest is published, so a batch that fails half-way leaves no trace, and one that is delivered
again is skipped. A batch is known by its stream and its number in it: a stream with a new
checkpoint counts from 0 again, and its batches are new. One writer per table at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from .. import files
from ..functions.codecs import key_partition
from ..sources.sinks import stream_of

_BUCKET, _SHARE = "_bucket", "_share"
_PART = "_part"

# Keys that take up to so many bytes are broadcast; more are joined with a shuffle.
BROADCAST_BYTES = 64 * 2**20
# What a key takes besides its text.
KEY_OVERHEAD = 32
# A task of a compaction gets about so many bytes of files. In memory, sorted, they are some ten times as many.
TASK_BYTES = 32 * 2**20


@dataclass
class Manifest:
    version: int = 0
    # stream -> the last of its batches that counts; "" for batches without a stream
    streams: dict[str, int] = field(default_factory=dict)
    # bucket -> folder that holds it
    buckets: dict[str, str] = field(default_factory=dict)
    # batches not compacted yet, the buckets that each touches, and the bytes of its keys
    batches: dict[str, list[int]] = field(default_factory=dict)
    key_bytes: dict[str, int] = field(default_factory=dict)

    @property
    def last_batch(self) -> int | None:
        """The last batch that counts, for a table with one stream."""
        return max(self.streams.values(), default=None)


@dataclass
class Staged:
    """A batch that is written but does not count yet."""
    batch_id: int
    stream: str
    folder: str
    buckets: list[int]
    key_bytes: int


def with_keys_of(rows: DataFrame, others: DataFrame, key_bytes: int, keys: list[str],
                 how: str = "left_semi") -> DataFrame:
    """Rows whose key does, or with ``left_anti`` does not, occur in others. NULL keys match.

    ``key_bytes`` is the measured size of the others' keys. Small ones are broadcast and the rows,
    which may be a whole table, stay where they are.
    """
    wanted = others.select(*[F.col(k).alias(f"_other_{k}") for k in keys])
    if key_bytes <= BROADCAST_BYTES:
        wanted = F.broadcast(wanted)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys])
    return rows.join(wanted, same, how)


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType,
                 merge: Callable[[DataFrame, list[str]], DataFrame], keys: list[str],
                 bucket_by: list[str], buckets: int = 16):
        """``merge`` combines rows of the same ``keys``; it must not mind in which order or how
        often it is applied. Its second argument are columns to carry along as part of the key.
        ``bucket_by`` must be among the keys. Choose ``buckets`` so that one bucket is a good
        file size (some hundred MB): a bucket is what compaction rewrites.
        """
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.merge, self.keys, self.bucket_by, self.buckets = merge, keys, bucket_by, buckets

    # -- manifests -----------------------------------------------------------------------

    def manifest(self) -> Manifest:
        versions = [n for n in files.names(self.spark, f"{self.root}/manifests")
                    if n.endswith(".json") and not n.startswith(".")]
        if not versions:
            return Manifest()
        return Manifest(**json.loads(files.read_text(self.spark, f"{self.root}/manifests/{versions[-1]}")))

    def _publish(self, manifest: Manifest) -> None:
        files.publish_text(self.spark, f"{self.root}/manifests/{manifest.version:012d}.json",
                           json.dumps(vars(manifest)))

    # -- writing -------------------------------------------------------------------------

    def stage(self, rows: DataFrame, batch_id: int, merged: bool = False) -> Staged | None:
        """Write a batch without making it count. None when it counts already.

        ``merged`` says that no two rows share a key, which saves merging the batch.
        """
        stream = stream_of(batch_id)
        last = self.manifest().streams.get(stream)
        if last is not None and batch_id <= last:
            return None
        return self._write(rows, batch_id, stream, merged)

    def _write(self, rows: DataFrame, batch_id: int, stream: str, merged: bool) -> Staged:
        folder = f"{self.root}/batches/{batch_id:012d}-{uuid.uuid4().hex}"
        touched = Observation()
        # At most `buckets` small numbers come back to the driver.
        (
            (rows if merged else self.merge(rows, [])).select(*self.schema.names)
            .withColumn(_BUCKET, key_partition(self.bucket_by, self.buckets))
            .observe(touched, F.collect_set(_BUCKET).alias("buckets"), F.sum(self._key_size()).alias("key_bytes"))
            .write.parquet(folder)
        )
        found = touched.get
        return Staged(int(batch_id), stream, folder, sorted(found["buckets"] or []), found["key_bytes"] or 0)

    def _key_size(self) -> Column:
        text = F.concat_ws("", *[F.col(k).cast("string") for k in self.keys])
        return (F.octet_length(text) + KEY_OVERHEAD * len(self.keys)).cast("long")

    def staged_rows(self, staged: Staged) -> DataFrame:
        return self._read([staged.folder])

    def commit(self, staged: Staged) -> None:
        manifest = self.manifest()
        if staged.buckets:
            manifest.batches[staged.folder] = staged.buckets
            manifest.key_bytes[staged.folder] = staged.key_bytes
        manifest.version += 1
        manifest.streams[staged.stream] = staged.batch_id
        self._publish(manifest)

    def apply(self, rows: DataFrame, batch_id: int, merged: bool = False) -> bool:
        """Take a batch in; False when it was taken in before."""
        staged = self.stage(rows, batch_id, merged)
        if staged is None:
            return False
        self.commit(staged)
        return True

    def replace(self, rows: DataFrame, streams: dict[str, int] | None = None, merged: bool = False) -> None:
        """Make rows the whole table. This is no batch and uses up no number.

        ``streams`` says which batches the rows hold already; by default those that counted before.
        """
        manifest = self.manifest()
        staged = self._write(rows, 0, "", merged)
        whole = Manifest(manifest.version + 1, dict(manifest.streams if streams is None else streams))
        if staged.buckets:
            whole.batches, whole.key_bytes = {staged.folder: staged.buckets}, {staged.folder: staged.key_bytes}
        self._publish(whole)

    def compact(self) -> None:
        """Fold the waiting batches into the buckets they touch; other buckets stay as they are."""
        manifest = self.manifest()
        if not manifest.batches:
            return
        touched = sorted({b for buckets in manifest.batches.values() for b in buckets})
        folder = f"{self.root}/buckets/{manifest.version + 1:012d}-{uuid.uuid4().hex}"
        sources = [manifest.buckets[str(b)] for b in touched if str(b) in manifest.buckets] + list(manifest.batches)
        # A large bucket is written by several tasks, each with its share of the keys.
        shares = max(1, -(-sum(files.size(self.spark, f) for f in sources) // (len(touched) * TASK_BYTES)))
        share = F.pmod(F.xxhash64(F.lit(_SHARE), *self.keys), F.lit(shares))
        place = F.array_position(F.array(*[F.lit(b) for b in touched]), F.col(_BUCKET)) - 1
        rows = self._read(sources).withColumn(_BUCKET, key_partition(self.bucket_by, self.buckets)) \
            .withColumn(_PART, (place * shares + share).cast("int"))
        # A task gets one part, by its number: by a hash several parts would meet in one. Rows of a key have
        # the same part, so one shuffle serves both the merge, which then groups by it and the key, and the
        # layout of the files.
        spread = rows.repartitionById(len(touched) * shares, _PART)
        merged = self.merge(spread, [_PART, _BUCKET])
        # Sorted by key, so that look-ups can skip pages; the merge of a keyed table leaves this order.
        merged.sortWithinPartitions(_PART, _BUCKET, *self.keys).drop(_PART).write.partitionBy(_BUCKET).parquet(folder)
        written = {n.partition("=")[2] for n in files.names(self.spark, folder) if "=" in n}
        for bucket in map(str, touched):
            manifest.buckets.pop(bucket, None)
            if bucket in written:
                manifest.buckets[bucket] = f"{folder}/{_BUCKET}={bucket}"
        manifest.batches, manifest.key_bytes = {}, {}
        manifest.version += 1
        self._publish(manifest)

    # -- reading -------------------------------------------------------------------------

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return files.empty(self.spark, self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def rows(self, by: list[str] | None = None) -> DataFrame:
        """The table now. Buckets without waiting batches are read as they are, and so are rows
        whose key has no waiting row as long as the waiting keys are small. A single waiting batch
        is merged already, so where nothing is stored it is read as it is, too.

        ``by`` names key columns to spread the rows by that are merged: what groups by these then
        needs no other shuffle. No value of them should have a large part of the keys.
        """
        def merged(rows: DataFrame) -> DataFrame:
            return self.merge(rows.repartition(*by) if by else rows, [])

        manifest = self.manifest()
        touched = {str(b) for buckets in manifest.batches.values() for b in buckets}
        settled = self._read([f for b, f in manifest.buckets.items() if b not in touched])
        if not manifest.batches:
            return settled
        waiting = self._read(list(manifest.batches))
        older = [f for b, f in manifest.buckets.items() if b in touched]
        if not older:
            return (waiting if len(manifest.batches) == 1 else merged(waiting)).unionByName(settled)
        stored, key_bytes = self._read(older), sum(manifest.key_bytes.values())
        if key_bytes <= BROADCAST_BYTES:
            settled = settled.unionByName(with_keys_of(stored, waiting, key_bytes, self.keys, "left_anti"))
            stored = with_keys_of(stored, waiting, key_bytes, self.keys)
        return merged(stored.unionByName(waiting)).unionByName(settled)

    def folders(self, buckets: list[int]) -> list[str]:
        """Where the rows of some buckets lie, and maybe others."""
        manifest, wanted = self.manifest(), set(buckets)
        return [f for b, f in manifest.buckets.items() if int(b) in wanted] \
            + [f for f, touched in manifest.batches.items() if wanted & set(touched)]

    def unmerged(self, buckets: list[int]) -> DataFrame:
        """All stored rows of some buckets, before merging: at least the rows that lie there."""
        return self._read(self.folders(buckets))

    # -- housekeeping --------------------------------------------------------------------

    def vacuum(self, keep_versions: int = 1) -> list[str]:
        """Delete all manifests but the last ``keep_versions``, and the folders that these do not list.

        Not while a batch is being staged, and readers of older versions must be done. The markers
        of deleted keys stay: however late an older change of such a key comes, it must not bring
        the row back.
        """
        names = [n for n in files.names(self.spark, f"{self.root}/manifests") if n.endswith(".json")]
        used: set[str] = set()
        for name in names[-keep_versions:]:
            m = Manifest(**json.loads(files.read_text(self.spark, f"{self.root}/manifests/{name}")))
            used |= set(m.batches) | {f.rsplit("/", 1)[0] for f in m.buckets.values()}
        gone = []
        for part in ("batches", "buckets"):
            for name in files.names(self.spark, f"{self.root}/{part}"):
                folder = f"{self.root}/{part}/{name}"
                if folder not in used:
                    files.delete(self.spark, folder)
                    gone.append(folder)
        # Last, so that a run that breaks off leaves nothing unlisted behind.
        for name in names[:-keep_versions]:
            files.delete(self.spark, f"{self.root}/manifests/{name}")
        return gone
