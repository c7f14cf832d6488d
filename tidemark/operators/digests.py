"""Reconciliation by digests of key ranges: only ranges that differ are compared key by key.

A digest is the number of a range's rows and the sum of their hashes: no order is needed, and the
digests of parts add up to the digest of the whole. The tree has two levels below the root. The
upper one has a bounded number of ranges, of which the driver learns which differ; equal ones are
not read again. The lower one has ranges of a few rows, whose number grows with the table and which
stay in Spark. With d rows that differ, about d small ranges are left to group by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..files import empty
from ..session import fresh_dir
from .quality import reconcile, row_hash
from .snapshots import KeyChunks

# Upper ranges; the driver gets at most so many numbers.
RANGES = 1024
# Rows of a lower range.
LEAF_ROWS = 64
# Lower ranges that differ are broadcast up to so many bytes; beyond that all rows of the upper ones are compared.
BROADCAST_BYTES = 64 * 2**20
# Bounds of so many stretches of upper ranges are handed to the scan.
STRETCHES = 64


def _ranged(keys: list[str], schema: T.StructType) -> bool:
    """Whether the first key is a whole number, and so has ranges that a scan can skip."""
    return isinstance(schema[keys[0]].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))


def digests(source: DataFrame, target: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Rows and hash sums of both sides, source minus target, where they are not alike.

    One grouping over both sides; a task sends one row for each of its ranges.
    """
    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*by, F.lit(sign).alias("_sign"), (row_hash(columns).cast("decimal(20,0)") * sign).alias("_hash"))
    return side(source, 1).unionByName(side(target, -1)).groupBy(*by).agg(
        F.sum("_sign").alias("_rows"), F.sum("_hash").alias("_balance")).filter("_rows <> 0 OR _balance <> 0")


def stretches(numbers: list[int], most: int = STRETCHES) -> list[tuple[int, int]]:
    """Runs of neighbouring numbers as (first, last + 1); the nearest runs are joined while there are too many."""
    runs: list[list[int]] = []
    for n in sorted(numbers):
        if runs and n == runs[-1][1]:
            runs[-1][1] = n + 1
        else:
            runs.append([n, n + 1])
    if len(runs) > most:
        gaps = sorted(range(1, len(runs)), key=lambda i: runs[i][0] - runs[i - 1][1])
        joined = set(gaps[:len(runs) - most])
        kept: list[list[int]] = []
        for i, run in enumerate(runs):
            if i in joined:
                kept[-1][1] = run[1]
            else:
                kept.append(run)
        runs = kept
    return [(a, b) for a, b in runs]


def digest_diff(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str],
                ranges: int = RANGES, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The keys on which two tables differ, as ``reconcile`` reports them, without those that are the same.

    Both tables are scanned for the upper digests; if none differ, that is all. The second scan reads
    the ranges that differ (their bounds are handed to the scan where the first key is a whole
    number), and so does the third, which keeps the small ranges that differ and groups these by key.
    A key with a large part of the rows is summed in the tasks like any other.
    """
    spark, ranged = source.sparkSession, _ranged(keys, source.schema)
    place = F.col(keys[0]).cast("long") if ranged else F.xxhash64(*keys)
    s, t = source.withColumn("_place", place), target.withColumn("_place", place)
    bounds = s.select("_place").unionByName(t.select("_place")).agg(
        F.min("_place").alias("low"), F.max("_place").alias("high"), F.count("*").alias("n")).first()
    nothing = reconcile(source, target, keys, columns).schema
    if not bounds.n:
        return empty(spark, nothing)
    low, span = (bounds.low or 0), (bounds.high or 0) - (bounds.low or 0) + 1
    upper = KeyChunks("_place", low, -(-span // ranges), ranges)
    lower = KeyChunks("_place", low, max(1, span * leaf_rows * 2 // bounds.n), 2**31 - 1)
    differing = [r["_range"] for r in digests(
        s.withColumn("_range", upper.number()), t.withColumn("_range", upper.number()), ["_range"], columns).select("_range").collect()]
    if not differing:
        return empty(spark, nothing)

    def within(df: DataFrame) -> DataFrame:
        df = df.filter(upper.number().isin(differing))
        if ranged:
            by_key = KeyChunks(keys[0], low, upper.width, ranges)
            wanted = F.lit(False)
            for first, until in stretches(differing):
                wanted = wanted | by_key.between(first, until)
            df = df.filter(wanted)
        return df.withColumn("_leaf", lower.number())

    s, t = within(s), within(t)
    path = fresh_dir(spark, "digests")
    digests(s, t, ["_leaf"], columns).select("_leaf").write.parquet(path)
    leaves = spark.read.schema("_leaf int").parquet(path)
    if leaves.count() * 16 <= BROADCAST_BYTES:
        s, t = (df.join(F.broadcast(leaves), "_leaf", "left_semi") for df in (s, t))
    return reconcile(s, t, keys, columns).filter("status <> 'same'")
