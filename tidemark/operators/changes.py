"""Change-data operators.

A change is a row with ``op`` (+I insert, -U/+U update before/after, -D delete), one or more
order columns (``seq``) and the row's columns. An envelope holds both images of one change.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, Window as W, functions as F

# The kinds of change, and the names under which they arrive.
INSERT, BEFORE, AFTER, DELETE = "+I", "-U", "+U", "-D"
KIND_NAMES = {
    INSERT: ["INSERT", "c", "r", "+I"],
    BEFORE: ["UPDATE_BEFORE", "-U"],
    AFTER: ["UPDATE", "UPDATE_AFTER", "u", "+U"],
    DELETE: ["DELETE", "d", "-D"],
}


def change_kind(column: str | Column, unknown: str = "refuse") -> Column:
    """Any known name of a kind, as +I, -U, +U or -D.

    A table, count or view over a feed is wrong once a change is lost, so an unknown or missing
    kind fails the job when the row is read. ``unknown="null"`` gives NULL instead, for callers
    that count such rows.
    """
    if unknown not in ("refuse", "null"):
        raise ValueError(f"unknown must be 'refuse' or 'null', not {unknown!r}")
    column = F.col(column) if isinstance(column, str) else column
    kinds = [F.when(column.isin(names), kind) for kind, names in KIND_NAMES.items()]
    if unknown == "refuse":
        message = F.concat(F.lit("unknown kind of change: "), F.coalesce(column, F.lit("NULL")))
        kinds.append(F.raise_error(message).cast("string"))
    return F.coalesce(*kinds)


def split_images(envelopes: DataFrame, keep: list[str], kind: str = "op") -> DataFrame:
    """One row per image: inserts give +I, updates give -U and +U, deletes give -D.

    Envelopes that hold a single image of an update (-U before, +U after) give that image.
    """
    op = F.col("_kind")
    before, after = F.col("before"), F.col("after")
    images = F.array(
        F.struct(F.when(op == AFTER, BEFORE).when(op.isin(BEFORE, DELETE), op).alias("op"), before.alias("row")),
        F.struct(F.when(~op.isin(BEFORE, DELETE), op).alias("op"), after.alias("row")),
    )
    return (
        envelopes.select(*keep, change_kind(kind).alias("_kind"), "before", "after")
        .select(*keep, F.inline(images))
        .filter(F.col("op").isNotNull() & F.col("row").isNotNull())
        .select(*keep, "op", "row.*")
    )


def kind_records(records: DataFrame, kind: str = "op_type") -> DataFrame:
    """Changes from records that hold one image each, its kind in a column next to the row's own."""
    rest = [c for c in records.columns if c != kind]
    return records.select(*rest, change_kind(kind).alias("op"))


def taken_out() -> Column:
    """Whether an image is of a row that goes away."""
    return F.col("op").isin(BEFORE, DELETE)


def sign() -> Column:
    """+1 for a row that appears, -1 for one that goes away."""
    return F.when(taken_out(), -1).otherwise(1)


def running_count(changes: DataFrame) -> DataFrame:
    """Rows of the table that the changes describe. On a stream: complete output mode."""
    return changes.agg(F.coalesce(F.sum(sign()), F.lit(0)).cast("bigint").alias("row_count"))


def op_mix(changes: DataFrame, by: list[str] | None = None) -> DataFrame:
    return changes.groupBy(*(by or []), "op").agg(F.count("*").alias("changes"))


def latest_per_key(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last change of each key.

    Spark limits each group to its best row before the shuffle as well as after it, so a key
    that holds a large part of the input leaves every map task as a single row.
    """
    newest = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return changes.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def live_rows(latest: DataFrame) -> DataFrame:
    return latest.filter(F.col("op") != DELETE)


def materialize(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The table that the changes add up to: updates overwrite, deletes remove."""
    return live_rows(latest_per_key(changes.filter(F.col("op") != BEFORE), keys, order))


def apply_changes(table: DataFrame, changes: DataFrame, keys: list[str],
                  order: list[str]) -> DataFrame:
    """A table with unique keys after a batch of changes; all changes are newer than it.

    The changes are cut to one row per key first, so neither join side repeats a key.
    """
    latest = latest_per_key(changes.filter(F.col("op") != BEFORE), keys, order)
    kept = table.join(latest.select(*keys), keys, "left_anti")
    return kept.unionByName(live_rows(latest).select(*table.columns))


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame, seq: str = "seq") -> DataFrame:
    """Snapshot rows become inserts that precede every change."""
    first = snapshot.withColumns({"op": F.lit(INSERT), seq: F.lit(0).cast(changes.schema[seq].dataType)})
    return first.select(*changes.columns).unionByName(changes)


def diff_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Envelopes that lead from one version of a keyed table to another.

    Needs unique keys on both sides, so each key meets at most one partner.
    """
    values = [c for c in old.columns if c not in keys]
    def image(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*keys, *values).alias(name))
    joined = image(old, "before").join(image(new, "after"), keys, "full_outer")
    kind = (F.when(F.col("before").isNull(), INSERT).when(F.col("after").isNull(), DELETE)
            .when(~F.col("before").eqNullSafe(F.col("after")), AFTER))
    return joined.select(*keys, kind.alias("op"), "before", "after").filter(F.col("op").isNotNull())


def inserts_only(changes: DataFrame, others: str = "refuse") -> DataFrame:
    """Guard for targets that can only append.

    Such a target would repeat updated rows and keep deleted ones, so by default any change
    other than an insert fails the job when the rows are read. ``others="drop"`` leaves them out.
    """
    is_insert = F.col("op") == INSERT
    if others == "drop":
        return changes.filter(is_insert)
    if others != "refuse":
        raise ValueError(f"others must be 'refuse' or 'drop', not {others!r}")
    message = F.concat(F.lit("append-only target got a change of kind "),
                       F.coalesce(F.col("op"), F.lit("NULL")))
    return changes.filter(F.when(is_insert, True).otherwise(F.raise_error(message).cast("boolean")))


def drop_null_rows(df: DataFrame, required: list[str], counts: Observation | None = None) -> DataFrame:
    """Leave out rows that a target with NOT NULL columns would reject.

    ``counts`` observes, once the result is written, how many rows came (``rows``) and how many
    were left out (``dropped``).
    """
    if counts is not None:
        missing = reduce(or_, [F.col(c).isNull() for c in required], F.lit(False))
        df = df.observe(counts, F.count("*").alias("rows"), F.count_if(missing).alias("dropped"))
    return df.dropna(subset=required)
