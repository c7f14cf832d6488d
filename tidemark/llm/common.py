"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import fresh_dir

#: Fixed value: ASCII white space between words (space, tab, line feed, vertical tab, form feed, return).
SPACE = r"\x20\x09-\x0D"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared working folder and read it back.

    This cuts the lineage: a lost executor costs a re-read instead of a recomputation, and tables that
    are used several times are computed once. The reader needs no inference, so empty tables work.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_array(text: Column) -> Column:
    """The words of a text, `[^\\x20\\x09-\\x0D]+`; none for a null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words, without building them: blanks become one space, the ends are trimmed."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(bare) == 0, F.lit(0)).otherwise(
        F.size(F.split(bare, f"[{SPACE}]+"))).cast("long")


def running_sum(df: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the group up to and with this one.

    ``group`` + ``order`` must be a total order (repeated rows may tie, in any order). The rows are range
    partitioned by it, so a group of any size spreads over many tasks; each task sums its own range and
    adds what the group has in earlier ranges: one row per range and group, never a row per input row.
    """
    keys = [*group, *order]
    ranged = materialise(
        df.repartitionByRange(*keys).withColumn("__range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("__range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = ranged.groupBy("__range", *group).agg(F.sum(value).alias("__total"))
    before = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    offsets = totals.withColumn(
        "__before", F.coalesce(F.sum("__total").over(
            before.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__total")
    same = F.lit(True)
    left = ranged.withColumn("__inside", F.sum(value).over(inside)).alias("l")
    for key in ["__range", *group]:
        same = same & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return left.join(offsets.alias("r"), same).select(
        *[F.col(f"l.{c}") for c in df.columns], (F.col("l.__inside") + F.col("r.__before")).alias(out))
