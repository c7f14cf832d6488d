"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root): the component of each linked node; ``links`` has long columns u and v.

    Each round every node points to the one of least hash among itself and its neighbours, pointers are
    followed twice, and links are renamed by them; loops and repeats drop out. As hashes order the nodes at
    random, long chains shrink by a constant factor a round, so the rounds grow with the logarithm of the
    longest chain. Hubs are reduced by partial aggregation and joined under Spark's skew splitting.
    Links with a null end and loops are ignored; repeated links count once.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) \
            .filter(F.col("u") != F.col("v")).distinct()

    edges = materialise(both(links), "links")
    labels = materialise(edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct(), "labels")
    while not edges.isEmpty():
        best = edges.groupBy("u").agg(F.min_by("v", F.xxhash64("v")).alias("v"))
        step = materialise(best.select("u", F.when(
            F.xxhash64("v") < F.xxhash64("u"), F.col("v")).otherwise(F.col("u")).alias("p")), "pointers")
        jump = step.alias("a").join(step.alias("b"), F.col("a.p") == F.col("b.u")) \
            .select("a.u", F.col("b.p").alias("p"))
        step = materialise(jump, "pointers")
        to = step.select(F.col("u").alias("root"), "p")
        labels = materialise(labels.join(to, "root", "left").select(
            "node", F.coalesce("p", "root").alias("root")), "labels")
        edges = materialise(
            edges.join(step.withColumnRenamed("p", "pu"), "u")
            .join(step.select(F.col("u").alias("v"), F.col("p").alias("pv")), "v")
            .select(F.col("pu").alias("u"), F.col("pv").alias("v")).filter(F.col("u") != F.col("v")).distinct(),
            "links")
    return labels
