"""A table kept equal to its source by applying change batches by key."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from ..operators.changes import AFTER, BEFORE, DELETE, latest_per_key, live_rows, split_images
from ..operators.lookup import in_ranges, key_ranges
from . import versioned
from .versioned import Staged, VersionedTable, with_keys_of


class KeyedTable:
    """Upsert and delete by key.

    The last change by ``order`` wins, also when an older one arrives in a later batch: the
    stored rows keep their order columns, and deleted keys keep a marker. Changes that tie there
    are ordered by their other columns and then by kind (deletes last), the same way wherever
    two of them meet, so the outcome does not depend on batches or tasks.
    """

    def __init__(self, spark: SparkSession, root: str, row: T.StructType, keys: list[str],
                 order: list[str], buckets: int = 16):
        rest = [f.name for f in row.fields if f.name not in (*keys, *order) and not isinstance(f.dataType, T.MapType)]
        self.keys, self.order, self.row = keys, [*order, *rest, "op"], row
        stored = T.StructType([T.StructField("op", T.StringType()), *row.fields])
        self.table = VersionedTable(
            spark, root, stored, lambda df, also: latest_per_key(df, [*also, *keys], self.order),
            keys, keys, buckets)

    def stage(self, changes: DataFrame, batch_id: int) -> Staged | None:
        return self.table.stage(changes.filter(changes["op"] != BEFORE), batch_id)

    def apply(self, changes: DataFrame, batch_id: int) -> bool:
        staged = self.stage(changes, batch_id)
        if staged:
            self.table.commit(staged)
        return staged is not None

    def rows(self, by: list[str] | None = None) -> DataFrame:
        return live_rows(self.table.rows(by)).drop("op")

    def images(self, staged: Staged) -> DataFrame:
        """The rows that a staged batch takes out of the table (-U) and puts in (+U).

        Reads the buckets that the batch touches. Of a small batch, these are cut to its keys before
        anything is shuffled or merged: buckets are sorted by key, and the ranges of the batch's
        first key go to the scan, so a batch whose keys lie together reads a few pages of each. A
        large batch meets them in a single shuffle by key. A change older than the stored row has no
        effect.
        """
        new, stored = self.table.staged_rows(staged), self.table.unmerged(staged.buckets)
        fields = self.row.names
        if staged.key_bytes <= versioned.BROADCAST_BYTES:
            first = self.keys[0]
            near = in_ranges(first, key_ranges(new, first)) | F.col(first).isNull()
            old = latest_per_key(with_keys_of(stored.filter(near), new, staged.key_bytes, self.keys), self.keys, self.order)
            before = old.select(
                *[F.col(k).alias(f"_old_{k}") for k in self.keys], F.struct(*self.order).alias("_old_order"),
                F.when(F.col("op") != DELETE, F.struct(*fields)).alias("before"),
            )
            same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in self.keys])
            met = new.join(before, same, "left")
        else:
            # A key has one row in the batch and one in each batch or bucket before it. Its new row comes
            # first, so the row that follows is the one that was in the table.
            both = new.withColumn("_new", F.lit(True)).unionByName(stored.withColumn("_new", F.lit(False)))
            place = W.partitionBy(*self.keys).orderBy(F.col("_new").desc(), *[F.col(c).desc() for c in self.order])
            columns = ["op", *fields]
            following = {f"_old_{c}": F.lead(c).over(place) for c in ["_new", *columns]}
            # Without stored rows nothing follows, and the batch stays where it is.
            paired = both.withColumns({"_n": F.row_number().over(place), **following}).filter("_new AND _n = 1") \
                if self.table.folders(staged.buckets) else \
                new.withColumns({"_old__new": F.lit(None).cast("boolean"), **{f"_old_{c}": F.lit(None).cast(new.schema[c].dataType) for c in columns}})
            known = F.col("_old__new").isNotNull()
            met = paired.withColumns({
                "_old_order": F.when(known, F.struct(*[F.col(f"_old_{c}").alias(c) for c in self.order])),
                "before": F.when(known & (F.col("_old_op") != DELETE), F.struct(*[F.col(f"_old_{c}").alias(c) for c in fields]))})
        effective = F.col("_old_order").isNull() | (F.struct(*self.order) > F.col("_old_order"))
        envelopes = met.filter(effective).select(
            F.lit(AFTER).alias("op"), "before",
            F.when(F.col("op") != DELETE, F.struct(*fields)).alias("after"),
        )
        return split_images(envelopes, [])
