"""Queries on layouts that later queries profit from, and on profiles kept per load, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Window as W, functions as F

from ..operators import star
from ..operators.loads import error_bound, profile_loads, running_profiles
from ..operators.lookup import rows_of_keys
from ..operators.ranking import newest
from ..session import fresh_dir
from ..sources import sinks
from ..streaming.view import apply_to_both
from . import tables as D
from .oracle import CURRENT_VIEW, DIMS, ORACLE, view
from .queries import dims, fact_view, keyed_table, lines, query


@query
def lookup_sorted(spark, sf_dir):
    """All lines of the newest hundred orders, from a table sorted by key: the scan skips the rest."""
    path, source = fresh_dir(spark, "by-key"), lines(spark, sf_dir)
    sinks.write_by_key(source, path, D.LINE_KEY)
    wanted = newest(D.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"], 100)
    stored = spark.read.schema(source.schema).parquet(path)
    return rows_of_keys(stored, wanted, ["l_orderkey"]).select(*D.LINE_KEY, "l_partkey", "l_shipdate", "l_extendedprice")


@query
def view_small_batches(spark, sf_dir):
    """The view over a compacted table that then takes small batches: all but the last weeks of the
    feed, and the rest in three parts by order key, so that the keys of a batch lie together."""
    home = fresh_dir(spark, "small-batches")
    keyed, stored = keyed_table(spark, f"{home}/table"), fact_view(spark, f"{home}/view")
    feed = D.line_changes(lines(spark, sf_dir))
    late = F.coalesce(F.col("l_shipdate") >= F.lit("2001-10-01").cast("timestamp_ntz"), F.lit(False))
    apply_to_both(feed.filter(~late), 0, keyed, stored)
    keyed.table.compact()
    stored.sums.compact()
    ends = feed.agg(F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high")).first()
    third = ((ends.high or 0) - (ends.low or 0)) // 3 + 1
    place = F.least(F.floor((F.col("l_orderkey") - F.lit(ends.low or 0)) / third), F.lit(2))
    for n in range(3):
        apply_to_both(feed.filter(late & (place == n)), n + 1, keyed, stored)
    return stored.rows(*dims(spark, sf_dir))


@query
def bucketed_join(spark, sf_dir):
    """Lines and orders laid out by order key, joined and summed per order without a shuffle."""
    name, home = uuid.uuid4().hex, fresh_dir(spark, "bucketed")
    sinks.create_bucketed(lines(spark, sf_dir), f"lines_{name}", "l_orderkey", 16, f"{home}/lines")
    sinks.create_bucketed(D.table(spark, sf_dir, "orders"), f"orders_{name}", "o_orderkey", 16, f"{home}/orders")
    joined = spark.table(f"lines_{name}").join(spark.table(f"orders_{name}"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("l_orderkey").agg(
        F.count("*").alias("line_count"), F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("amount"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent_lines"))


@query
def view_stored_by_store(spark, sf_dir):
    """The daily store view stored by store: each store's days in one file, summed without a shuffle."""
    name, home = f"view_{uuid.uuid4().hex}", fresh_dir(spark, "view-by-store")
    computed = star.daily_store_view(D.fact(lines(spark, sf_dir)), *dims(spark, sf_dir))
    sinks.create_bucketed(computed, name, "ss_store_sk", 16, f"{home}/view")
    stored = spark.table(name).select("*", F.xxhash64("_metadata.file_name").alias("file"))
    return stored.groupBy("ss_store_sk").agg(
        (F.min("file") == F.max("file")).alias("in_one_file"), F.count("*").alias("days"),
        F.sum("total_sales_amount").alias("sales_amount"), F.sum("transaction_count").alias("transaction_count"))


@query
def profile_by_load(spark, sf_dir):
    """Lines loaded year by year. The profile of all loads up to each, from the kept ones, with whether
    the estimated number of distinct items keeps to its bound around the exact one."""
    loaded = lines(spark, sf_dir).select(
        F.coalesce(F.year("l_shipdate"), F.lit(0)).alias("load"), "l_orderkey", "l_partkey",
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"))
    path = fresh_dir(spark, "profiles")
    kept = profile_loads(loaded, "load", "l_orderkey", "l_partkey", "amount")
    kept.write.parquet(path)
    profiles = spark.read.schema(kept.schema).parquet(path)
    merged = running_profiles(profiles, "load")
    new = loaded.groupBy("l_partkey").agg(F.min("load").alias("load")).groupBy("load").agg(F.count("*").alias("new_items"))
    so_far = W.orderBy("load").rowsBetween(W.unboundedPreceding, 0)
    exact = profiles.select("load").join(new, "load", "left").select("load", F.sum("new_items").over(so_far).alias("exact_items"))
    close = F.abs(F.col("distinct_items") - F.col("exact_items")) <= F.greatest(F.lit(1), F.col("exact_items") * error_bound())
    return merged.join(exact, "load").select(
        F.col("load").alias("up_to"), "row_count", "total_amount", "min_key", "max_key", "exact_items", close.alias("within_bound"))


ORACLE |= {
    "lookup_sorted": """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_shipdate, l_extendedprice
      FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 100)""",
    "view_small_batches": CURRENT_VIEW,
    "bucketed_join": """SELECT l_orderkey, count(*) AS line_count, sum(l_extendedprice::DECIMAL(12,2))::DOUBLE AS amount,
      count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent_lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "view_stored_by_store": f"""WITH {DIMS}, v AS ({view('lineitem')})
      SELECT ss_store_sk, TRUE AS in_one_file, count(*) AS days, sum(total_sales_amount::DECIMAL(28,4))::DOUBLE AS sales_amount,
        sum(transaction_count)::BIGINT AS transaction_count FROM v GROUP BY 1""",
    "profile_by_load": """WITH y AS (SELECT DISTINCT coalesce(year(l_shipdate), 0) AS up_to FROM lineitem)
      SELECT up_to, count(*) AS row_count, sum(l_extendedprice::DECIMAL(12,2))::DOUBLE AS total_amount, min(l_orderkey) AS min_key,
        max(l_orderkey) AS max_key, count(DISTINCT l_partkey) AS exact_items, TRUE AS within_bound
      FROM y JOIN lineitem ON coalesce(year(l_shipdate), 0) <= up_to GROUP BY up_to""",
}
