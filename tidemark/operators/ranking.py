"""Dense row numbers, newest rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from ..session import fresh_dir

# monotonically_increasing_id() keeps the position within a partition in its low 33 bits.
_POSITION_BITS = 2**33 - 1


def with_dense_id(df: DataFrame, order: list[str], name: str = "row_id",
                  partitions: int | None = None) -> DataFrame:
    """Number the rows 1..n by ``order`` without sorting them in one task.

    Rows are split into ranges of the order, numbered within their range, and shifted by the
    sizes of the ranges before it. ``order`` should be a total order: then the ranges stay even
    however often a leading value repeats. The numbered ranges are written to the shared
    folder, because the range bounds come from a sample and the counting and the numbering must
    see the same ranges, also after an executor is lost.
    """
    spark = df.sparkSession
    ranges = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = fresh_dir(spark, "dense-id")
    (
        df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        .withColumns({
            "_range": F.spark_partition_id(),
            "_position": F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)),
        })
        .write.parquet(path)
    )
    written = T.StructType([*df.schema.fields, T.StructField("_range", T.IntegerType()),
                            T.StructField("_position", T.LongType())])
    numbered = spark.read.schema(written).parquet(path)
    # One row per range, so both the ordered window and the broadcast are bounded by `ranges`.
    sizes = numbered.groupBy("_range").agg(F.count("*").alias("_size"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return numbered.join(F.broadcast(offsets), "_range").select(
        (F.col("_offset") + F.col("_position") + 1).alias(name), *df.columns
    )


def newest(df: DataFrame, by: list[str], n: int) -> DataFrame:
    """The n newest rows. Give a unique last column, or ties come out in any order.

    Each task keeps its own n best rows, so only n rows per task reach the final merge.
    """
    return df.orderBy(*[F.col(c).desc() for c in by]).limit(n)
