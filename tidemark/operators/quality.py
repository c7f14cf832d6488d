"""Checks on synchronized tables: profile, key verdict, reconciliation, clocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..files import is_dir
from ..functions.temporal import whole_hour_shift

# The texts of the key check.
KEYS_UNIQUE, KEYS_REPEATED = "主键唯一", "存在重复主键"


def profile(df: DataFrame, key: str, item: str, amount: str, stamp: str) -> DataFrame:
    """One row: size, first and last load time, distinct items, total amount, key range."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.min(stamp).alias("first_sync"), F.max(stamp).alias("last_sync"),
        F.count_distinct(item).alias("distinct_items"),
        F.sum(amount).alias("total_amount"),
        F.min(key).alias("min_key"), F.max(key).alias("max_key"),
    )


def key_check(df: DataFrame, key: str) -> DataFrame:
    rows, keys = F.col("row_count"), F.col("unique_keys")
    return df.agg(
        F.count("*").alias("row_count"), F.count_distinct(key).alias("unique_keys")
    ).withColumn("key_status", F.when(rows == keys, KEYS_UNIQUE).otherwise(KEYS_REPEATED))


def row_hash(columns: list[str]):
    """64-bit hash of a row. Hashing skips NULLs, so which columns are NULL is hashed too."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def reconcile(source: DataFrame, target: DataFrame, keys: list[str],
              columns: list[str]) -> DataFrame:
    """Per key: rows on each side and whether they agree.

    Both sides go through one grouping on the key rather than a join. Only key, count and hash
    sum are shuffled, each map task sends a key at most once, and a key that is repeated on
    both sides does not multiply.
    """
    def side(df: DataFrame, in_source: int) -> DataFrame:
        return df.select(
            *keys, F.lit(in_source).alias("_s"), F.lit(1 - in_source).alias("_t"),
            row_hash(columns).cast("decimal(20,0)").alias("_h"),
        )
    s, t = F.col("source_rows"), F.col("target_rows")
    return (
        side(source, 1).unionByName(side(target, 0))
        .groupBy(*keys)
        .agg(F.sum("_s").alias("source_rows"), F.sum("_t").alias("target_rows"),
             F.sum(F.col("_h") * (F.col("_s") - F.col("_t"))).alias("_balance"))
        .select(*keys, "source_rows", "target_rows",
                F.when(t == 0, "missing").when(s == 0, "extra")
                .when((s != t) | (F.col("_balance") != 0), "different")
                .otherwise("same").alias("status"))
    )


def reconcile_summary(source: DataFrame, target: DataFrame, keys: list[str],
                      columns: list[str]) -> DataFrame:
    return reconcile(source, target, keys, columns).groupBy("status").agg(
        F.count("*").alias("keys"), F.sum("source_rows").alias("source_rows"),
        F.sum("target_rows").alias("target_rows"),
    )


def clock_shifts(df: DataFrame, source_ts: str, event_ts: str) -> DataFrame:
    """Rows by whole-hour shift between two clocks; anything but 0 hints at a zone mix-up.

    Pairs that are not near a whole number of hours apart count under a NULL shift.
    """
    return (
        df.select(whole_hour_shift(F.col(source_ts), F.col(event_ts)).alias("shift_hours"))
        .groupBy("shift_hours").agg(F.count("*").alias("row_count"))
        .withColumn("zone_suspect", F.coalesce(F.col("shift_hours") != 0, F.lit(False)))
    )


def target_status(spark: SparkSession, table_or_path: str) -> str:
    """Whether a catalog table, or a folder when the name has a slash, is there."""
    there = is_dir(spark, table_or_path) if "/" in table_or_path \
        else spark.catalog.tableExists(table_or_path)
    return "EXISTS" if there else "NOT EXISTS"
