"""Profiles that are kept per load and merged for any span of loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# Registers of a sketch, as a power of two: its relative standard error is about 1.04 / sqrt(2 ** this).
SKETCH_SIZE = 12
# An estimate may be off by so many standard errors.
ERRORS = 3


def profile_loads(df: DataFrame, load: str, key: str, item: str, amount: str, sketch: int = SKETCH_SIZE) -> DataFrame:
    """One row for each load: rows, total amount, key range, and a sketch of the distinct items.

    All of it adds up, so a load is read once, when it comes; a later question for any span of
    loads reads these rows. A task sends one sketch of a few KB for each of its loads.
    """
    return df.groupBy(load).agg(
        F.count("*").alias("row_count"), F.sum(amount).alias("total_amount"), F.min(key).alias("min_key"),
        F.max(key).alias("max_key"), F.hll_sketch_agg(item, sketch).alias("items"))


def _merged() -> dict[str, Column]:
    return {"row_count": F.sum("row_count"), "total_amount": F.sum("total_amount"), "min_key": F.min("min_key"),
            "max_key": F.max("max_key"), "items": F.hll_union_agg("items")}


def merge_profiles(profiles: DataFrame, by: list[str]) -> DataFrame:
    """The profiles of all loads of each group, with an estimate of their distinct items."""
    merged = profiles.groupBy(*by).agg(*[c.alias(n) for n, c in _merged().items()])
    return merged.withColumn("distinct_items", F.hll_sketch_estimate("items")).drop("items")


def running_profiles(profiles: DataFrame, load: str) -> DataFrame:
    """For each load the profile of all loads up to it. The window is one task: it has a row for each load."""
    so_far = W.orderBy(load).rowsBetween(W.unboundedPreceding, 0)
    merged = profiles.select(load, *[c.over(so_far).alias(n) for n, c in _merged().items()])
    return merged.withColumn("distinct_items", F.hll_sketch_estimate("items")).drop("items")


def error_bound(sketch: int = SKETCH_SIZE, errors: int = ERRORS) -> float:
    """How far an estimate may be off, as a part of the true number."""
    return errors * 1.04 / 2 ** (sketch / 2)
