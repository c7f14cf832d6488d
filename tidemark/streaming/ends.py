"""First and last rows of groups, kept under inserts, updates and deletes."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from ..operators.changes import AFTER, DELETE, sign
from ..session import fresh_dir
from ..sources.sinks import stream_of
from .keyed import KeyedTable

FIRST, LAST = "first", "last"
KEEP = 8


class MaintainedEnds:
    """Keeps the first and the last ``keep`` rows of each group by an order, and the number of its rows.

    A minimum cannot be taken back like a sum: when its row goes away, the next one must be known.
    So each end holds some rows, and they are exactly the outermost ones of the group. A new row
    counts if it lies within what an end holds (or the end holds the whole group); a deleted one
    is taken out of it. Rows further inside only change the number of rows. An end that has run out
    while rows are left is filled again from the table, for these groups alone.

    A batch costs its own rows and the ends of the groups that it touches, a bounded number of rows
    for each. No group is ever collected: a group with a third of a batch's rows leaves each task with
    ``keep`` rows for an end. Repeated rows count with their copies.
    """

    def __init__(self, spark: SparkSession, root: str, row: T.StructType, group: list[str], order: list[str],
                 keep: int = KEEP, buckets: int = 16):
        """``row`` has the columns of ``group``, of ``order`` and any others; rows of a group that agree in
        ``order`` are ordered by the others."""
        self.spark, self.root, self.group, self.keep, self.row = spark, root.rstrip("/"), group, keep, row
        self.rank = [*order, *[f.name for f in row.fields if f.name not in (*group, *order)]]
        kept = T.StructType([
            *[row[g] for g in group], T.StructField("_end", T.StringType()), T.StructField("_slot", T.IntegerType()),
            T.StructField("_version", T.LongType()), T.StructField("_copies", T.LongType()), T.StructField("_rows", T.LongType()),
            *[row[c] for c in self.rank]])
        self.slots = KeyedTable(spark, f"{self.root}/ends", kept, [*group, "_end", "_slot"], ["_version"], buckets)

    def apply(self, images: DataFrame, table: DataFrame, batch_id: int) -> bool:
        """Take a batch of row images (+I, -U, +U, -D) in; False if it was taken in before.

        ``table`` has the rows before the batch. It is read only if an end has run out, and then for
        the groups concerned.
        """
        last = self.slots.table.manifest().streams.get(stream_of(batch_id))
        if last is not None and batch_id <= last:
            return False
        home, names = fresh_dir(self.spark, "ends"), [*self.group, *self.rank]
        change = self._stored(images.select(*names, sign().cast("long").alias("_copies")), f"{home}/change")
        # A group has a bounded number of slots, so all of them may meet in one task.
        held = self.slots.rows(self.group)
        groups = self._stored(self._touched(held, change), f"{home}/groups")
        rows = self._stored(self._near(held, change, groups), f"{home}/rows")
        ends = [self._stored(self._outermost(rows.filter(F.col("_end") == end), end), f"{home}/{end}") for end in (FIRST, LAST)]
        state = self._stored(self._state(groups, ends), f"{home}/state")
        ends += self._refilled(state, change, table, f"{home}/again")
        # The keys of these are unique: nothing to merge.
        self.slots.table.apply(self._changes(ends, state, batch_id), batch_id, merged=True)
        return True

    def _stored(self, df: DataFrame, path: str) -> DataFrame:
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _net(self, rows: DataFrame) -> DataFrame:
        """Copies of each row, summed; rows that come and go within are gone."""
        return rows.groupBy(*self.group, *self.rank).agg(F.sum("_copies").alias("_copies")).filter("_copies <> 0")

    def _joined(self, left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        """By group, NULLs alike; the left side's group columns stay."""
        other = right.select(*[F.col(c).alias(f"_r_{c}") if c in self.group else F.col(c) for c in right.columns])
        same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"_r_{g}")) for g in self.group])
        return left.join(other, same, how).drop(*[f"_r_{g}" for g in self.group])

    def _of_end(self, end: str) -> list[str]:
        """The names of what is known of an end: its innermost row and how deep it is."""
        return [f"_{end}_{c}" for c in ("_depth", "_held", *self.rank)]

    def _touched(self, held: DataFrame, change: DataFrame) -> DataFrame:
        """A row for each group of the batch: its rows before and after, and the innermost row that each end holds."""
        slots = W.partitionBy(*self.group, "_end")
        deep = held.withColumn("_depth", F.max("_slot").over(slots))
        known = [F.max(F.when(F.col("_slot") == 0, F.col("_rows"))).alias("_were")]
        for end in (FIRST, LAST):
            of = (F.col("_end") == end) & (F.col("_slot") > 0)
            inner = of & (F.col("_slot") == F.col("_depth"))
            values = [F.max(F.when(of, F.col("_slot"))), F.sum(F.when(of, F.col("_copies"))),
                      *[F.max(F.when(inner, F.col(c))) for c in self.rank]]
            known += [v.alias(n) for v, n in zip(values, self._of_end(end))]
        before = deep.groupBy(*self.group).agg(*known)
        both = before.unionByName(change.select(*self.group, F.col("_copies").alias("_more")), allowMissingColumns=True)
        names = ["_were", *self._of_end(FIRST), *self._of_end(LAST)]
        found = both.groupBy(*self.group).agg(F.sum("_more").alias("_more"), *[F.max(n).alias(n) for n in names])
        were = F.coalesce("_were", F.lit(0)).cast("long")
        return found.filter(F.col("_more").isNotNull()).select(
            *self.group, were.alias("_were"), (were + F.col("_more")).alias("_are"), *names[1:])

    def _near(self, held: DataFrame, change: DataFrame, groups: DataFrame) -> DataFrame:
        """By end, the rows that may lie in it: those held, and those of the batch that are within its reach."""
        rows = held.filter("_slot > 0").select(*self.group, *self.rank, "_copies", "_end").unionByName(
            change.withColumn("_end", F.lit(None).cast("string")))
        placed, row, reached = self._joined(rows, groups, "inner"), F.struct(*self.rank), []
        for end in (FIRST, LAST):
            depth, count, *inner = self._of_end(end)
            reach = F.struct(*[F.col(n).alias(c) for n, c in zip(inner, self.rank)])
            within = row <= reach if end == FIRST else row >= reach
            # An end that holds all rows of its group knows all.
            whole = F.coalesce(count, F.lit(0)) == F.col("_were")
            near = whole | (F.col(depth).isNotNull() & within)
            mine = F.when(F.col("_end").isNull(), near).otherwise(F.col("_end") == end)
            reached.append(F.when(mine, F.lit(end)))
        ends = placed.select(*self.group, *self.rank, "_copies", F.explode(F.array_compact(F.array(*reached))).alias("_end"))
        return ends.groupBy(*self.group, "_end", *self.rank).agg(F.sum("_copies").alias("_copies")).filter("_copies > 0")

    def _outermost(self, rows: DataFrame, end: str) -> DataFrame:
        """The first ``keep`` different rows of each group from an end, numbered from 1."""
        direction = [F.col(c).asc() if end == FIRST else F.col(c).desc() for c in self.rank]
        slots = F.row_number().over(W.partitionBy(*self.group).orderBy(*direction))
        kept = rows.withColumn("_slot", slots).filter(F.col("_slot") <= self.keep)
        return kept.select(*self.group, *self.rank, "_copies", "_slot", F.lit(end).alias("_end"))

    def _state(self, groups: DataFrame, ends: list[DataFrame]) -> DataFrame:
        """The groups of the batch with the depth of each end before it and after."""
        depths = [f"_{end}__depth" for end in (FIRST, LAST)]
        both = groups.select(*self.group, "_are", *depths)
        for end, rows in zip((FIRST, LAST), ends):
            both = both.unionByName(rows.select(*self.group, F.col("_slot").alias(f"_{end}_now")), allowMissingColumns=True)
        return both.groupBy(*self.group).agg(*[F.max(c).alias(c) for c in ("_are", *depths, f"_{FIRST}_now", f"_{LAST}_now")])

    def _refilled(self, state: DataFrame, change: DataFrame, table: DataFrame, path: str) -> list[DataFrame]:
        """The ends of groups that have rows but none at an end any more; the table is read once for both."""
        out = [F.when(F.col(f"_{end}_now").isNull(), F.lit(end)) for end in (FIRST, LAST)]
        dry = self._stored(state.filter("_are > 0").select(*self.group, F.array_compact(F.array(*out)).alias("_out"))
                           .filter(F.size("_out") > 0), path)
        if dry.isEmpty():
            return []
        rows = table.select(*self.group, *self.rank, F.lit(1).cast("long").alias("_copies")).unionByName(change)
        now = self._stored(self._net(self._joined(rows, dry.select(*self.group), "left_semi")).filter("_copies > 0"), f"{path}-rows")
        return [self._outermost(self._joined(now, dry.filter(F.array_contains("_out", end)).select(*self.group), "left_semi"), end)
                for end in (FIRST, LAST)]

    def _changes(self, ends: list[DataFrame], state: DataFrame, batch_id: int) -> DataFrame:
        """Slots to write, and slots to delete: those that were held and are not any more."""
        fields = self.slots.row.fields
        def shaped(df: DataFrame, op) -> DataFrame:
            have = set(df.columns)
            return df.select(op.alias("op"), *[
                (F.lit(int(batch_id)) if f.name == "_version" else F.col(f.name) if f.name in have else F.lit(None))
                .cast(f.dataType).alias(f.name) for f in fields])
        new = [shaped(end, F.lit(AFTER)) for end in ends]
        heads = shaped(state.withColumns({"_end": F.lit(""), "_slot": F.lit(0), "_rows": F.col("_are")}),
                       F.when(F.col("_are") > 0, AFTER).otherwise(DELETE))
        return reduce(DataFrame.unionByName, [*new, heads, *[shaped(gone, F.lit(DELETE)) for gone in self._gone(ends, state)]])

    def _gone(self, ends: list[DataFrame], state: DataFrame) -> list[DataFrame]:
        """Slots are numbered without gaps, so those that an end has lost are the last ones."""
        gone = []
        for end, again in zip((FIRST, LAST), ends[2:] or [None, None]):
            lost = state.filter(F.col(f"_{end}__depth") > F.coalesce(f"_{end}_now", F.lit(0))).select(
                *self.group, F.lit(end).alias("_end"),
                F.explode(F.sequence(F.coalesce(f"_{end}_now", F.lit(0)) + 1, F.col(f"_{end}__depth"))).alias("_slot"))
            if again is not None:
                # What was filled again is written instead.
                same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in [*self.group, "_slot"]])
                lost = lost.join(again.select(*[F.col(c).alias(f"_n_{c}") for c in [*self.group, "_slot"]]), same, "left_anti")
            gone.append(lost)
        return gone

    def rows(self) -> DataFrame:
        """For each group the number of its rows, ``first`` and ``last``: the outermost rows as structs."""
        outer = self.slots.rows(self.group).filter("_slot <= 1")
        found = [F.max(F.when(F.col("_slot") == 0, F.col("_rows"))).alias("n_rows")]
        for end in (FIRST, LAST):
            of = (F.col("_slot") == 1) & (F.col("_end") == end)
            found += [F.max(of).alias(f"_{end}"), *[F.max(F.when(of, F.col(c))).alias(f"_{end}_{c}") for c in self.rank]]
        ends = [F.when(F.col(f"_{end}"), F.struct(*[F.col(f"_{end}_{c}").alias(c) for c in self.rank])).alias(end) for end in (FIRST, LAST)]
        return outer.groupBy(*self.group).agg(*found).filter(F.col("n_rows").isNotNull()).select(*self.group, "n_rows", *ends)
