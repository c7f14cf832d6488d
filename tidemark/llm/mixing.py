"""Mixing sources to target weights by weighted fair queueing.

Every document of a source waits in a shuffled queue, up to three times over. Its virtual finish time is the
number of words up to and with it in its source's queue, divided by the source's target. Sorted by that time,
all sources advance in proportion to their targets; the mix ends where the total budget is used up. Both
running sums are taken over ranges of the sort order, so a source with a third of all rows is spread out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.ranking import with_dense_id
from .common import SPACE, materialise, read, running_sum, word_count

#: A document is taken so many times at most.
REPEATS = 3
SEED = "mix"


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target: one row per source, from rows with source and size.

    Sources by code point, null last, weigh 1, 2, 3, 1, ...; the budget is the sum of all sizes. No target
    passes REPEATS times its source's size: taken in ascending order of that cap per weight, a source is
    capped if its share of what the capped ones before it leave is above the cap. The sources are numbered and
    summed in ranges, so there may be as many of them as there are documents; three numbers reach the driver.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("unnamed", F.col("source").isNull())
    listed = (
        with_dense_id(sources, ["unnamed", "source"], "nth").drop("unnamed")
        .withColumn("weight", ((F.col("nth") - 1) % 3 + 1).cast("long"))
        .withColumn("cap", REPEATS * F.col("source_size")).withColumn("turn", F.col("cap") / F.col("weight")))
    queue = materialise(running_sum(
        running_sum(listed, [], ["turn", "nth"], "cap", "caps"), [], ["turn", "nth"], "weight", "weighed"), "sources")
    total = queue.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    left = F.lit(total["size"]).cast("long") - (F.col("caps") - F.col("cap"))
    weights = F.lit(total["weight"]).cast("long") - (F.col("weighed") - F.col("weight"))
    free = F.col("cap").cast("double") * weights >= F.col("weight") * left.cast("double")
    # The first free source holds what is left for it and all after it.
    first = queue.filter(free).agg(F.min(F.struct(
        "turn", "nth", left.cast("double").alias("left"), weights.alias("weights"))).alias("of")).first()["of"]
    capped = F.col("cap").cast("double")
    if first is None:
        return queue.select("source", "source_size", capped.alias("target"))
    is_free = F.struct("turn", "nth") >= F.struct(F.lit(first["turn"]), F.lit(first["nth"]).cast("long"))
    return queue.select("source", "source_size", F.when(~is_free, capped).otherwise(
        F.col("weight") * F.lit(first["left"]) / F.lit(first["weights"])).alias("target"))


def _place(copy: Column) -> Column:
    """Shuffled place in a source's queue; the same on every run."""
    return F.substring(F.md5(F.concat_ws("-", F.lit(SEED), copy.cast("string"), F.coalesce(
        F.col("doc_id").cast("string"), F.lit("null"))).cast("binary")), 1, 16)


def mixed(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, version (hash of the text), size, source_size, target, copies.

    Null texts have size 0; documents without words are never taken (copies 0). Rows with a null doc_id and
    repeated rows count like any other. An empty table gives no rows.
    """
    sizes = materialise(
        docs.select("doc_id", "source", F.xxhash64("text").alias("version"), word_count(F.col("text")).alias("size"))
        .withColumn("row", F.monotonically_increasing_id()), "sizes")
    shares = materialise(targets(sizes), "targets")
    rows = sizes.alias("s").join(shares.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))) \
        .select("s.*", "t.source_size", "t.target")
    turns = F.least(F.lit(REPEATS), F.floor(F.col("target") / F.col("source_size")).cast("int") + 1)
    queue = (
        rows.filter("size > 0 and target > 0")
        .select("row", "doc_id", "source", "version", "size", "target", F.explode(F.sequence(F.lit(1), turns)).alias("copy"))
        .withColumn("place", _place(F.col("copy"))))
    # Texts that share an id come in the order of their hashes; repeats of a row are told apart by its number, so
    # they spread over ranges however many there are, and whichever comes first is the same document.
    own = ["doc_id", "size", "version", "row"]
    waiting = running_sum(queue, ["source"], ["copy", "place", *own], "size", "waited") \
        .withColumn("finish", F.col("waited").cast("double") / F.col("target"))
    budget = sizes.agg(F.sum("size")).first()[0] or 0
    mix = running_sum(waiting, [], ["finish", "source", "copy", "place", *own], "size", "used") \
        .filter(F.col("used") <= budget)
    copies = mix.groupBy("row").agg(F.count("*").alias("copies"))
    return rows.join(copies, "row", "left").select(
        "doc_id", "version", "size", "source_size", "target", F.coalesce("copies", F.lit(0)).alias("copies"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def taken(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken; rows that agree in doc_id and text are pooled."""
    copies = mixed(docs).groupBy("doc_id", "version").agg(F.sum("copies").cast("int").alias("__n")).filter("__n > 0")
    keyed = docs.withColumn("__version", F.xxhash64("text")).alias("d")
    return (
        keyed.join(copies.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id"))
                   & (F.col("d.__version") == F.col("c.version")))
        .select("d.*", "c.__n").dropDuplicates(["doc_id", "__version"])
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(*docs.columns))


SQL = f"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+')) AS BIGINT) AS size FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sizes GROUP BY source),
caps AS (
  SELECT *, 3 * source_size AS cap,
         CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0) AS DOUBLE) AS rest,
         sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weights
  FROM src WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
free AS (
  SELECT *, max(CASE WHEN CAST(cap AS DOUBLE) * weights >= weight * rest THEN 1 ELSE 0 END)
         OVER (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING) AS is_free FROM caps),
goal AS (
  SELECT source, source_size, CASE WHEN is_free = 0 THEN CAST(cap AS DOUBLE) ELSE weight *
         (SELECT rest FROM free WHERE is_free = 1 ORDER BY weights DESC LIMIT 1) /
         (SELECT weights FROM free WHERE is_free = 1 ORDER BY weights DESC LIMIT 1) END AS target FROM free),
docs AS (SELECT s.*, g.source_size, g.target FROM sizes s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
queue AS (
  SELECT *, substr(md5('{SEED}-' || copy || '-' || doc_id), 1, 16) AS place
  FROM docs, (SELECT unnest([1, 2, 3]) AS copy)
  WHERE size > 0 AND target > 0 AND copy <= floor(target / source_size) + 1),
waiting AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY copy, place, doc_id ROWS UNBOUNDED PRECEDING)
         AS DOUBLE) / target AS finish FROM queue),
mix AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS FIRST, copy, place, doc_id ROWS UNBOUNDED PRECEDING) AS used
  FROM waiting),
taken AS (SELECT doc_id, sum(size) AS taken FROM mix WHERE used <= (SELECT sum(size) FROM sizes) GROUP BY doc_id)
SELECT d.doc_id, d.size, d.source_size, d.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM docs d LEFT JOIN taken t USING (doc_id)
"""
