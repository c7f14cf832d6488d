"""What tasks hold and how often rows are shuffled, so that work and memory follow the input."""

import os

from pyspark.sql import functions as F

from tidemark import files
from tidemark.operators import changes as C
from tidemark.plans import queries as Q, tables as D
from tidemark.schemas import columns
from tidemark.session import work_dir
from tidemark.sources import feeds, sinks
from tidemark.streaming import versioned
from tidemark.streaming.ends import MaintainedEnds
from tidemark.streaming.keyed import KeyedTable

ROW = columns("id:long qty:int seq:long")
FEED = "op string, id long, qty int, seq long"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def numbered(spark, n, seq, op="+I"):
    return spark.range(n).select(F.lit(op).alias("op"), "id", F.hash("id", F.lit(seq)).alias("qty"), F.lit(seq).cast("long").alias("seq"))


def test_envelopes_are_kept_compressed(spark):
    some = spark.range(5000).select(
        (F.col("id") % 700).alias("l_orderkey"), (F.hash("id") % 900).cast("long").alias("l_partkey"), F.col("id").alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), F.lit(3.0).alias("l_quantity"), (F.col("id") * 1.5).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"),
        F.lit(0.1).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.lit("1997-01-01").cast("timestamp_ntz").alias("l_shipdate"))
    changes = D.wide_sales(some)
    home = work_dir(spark)
    before = set(files.names(spark, home))
    read = Q._change_scan(changes, "store_sales", D.STORE_SALES)
    folder, = set(files.names(spark, home)) - before
    text = D.as_envelopes(changes, "store_sales").agg(F.sum(F.octet_length("value"))).first()[0]
    assert files.size(spark, f"{home}/{folder}") * 3 < text
    assert read.count() == 5000 and read.select(*changes.columns).exceptAll(changes).count() == 0


def test_a_compaction_task_gets_one_part(spark, home, monkeypatch):
    monkeypatch.setattr(versioned, "TASK_BYTES", 4000)
    t = KeyedTable(spark, f"{home}/table", ROW, ["id"], ["seq"], 4)
    t.apply(numbered(spark, 20_000, 1), 0)
    t.apply(numbered(spark, 20_000, 2), 1)
    seen, merge = [], t.table.merge

    def watched(rows, also):
        seen.extend(r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect())
        return merge(rows, also)

    monkeypatch.setattr(t.table, "merge", watched)
    t.table.compact()
    assert len(seen) > 8 and max(seen) < 1.5 * sum(seen) / len(seen)
    assert versioned.TASK_BYTES * 4 < 256 * 2**20
    assert t.rows().count() == 20_000


def test_images_of_a_large_batch_shuffle_once(spark, home, monkeypatch):
    t = KeyedTable(spark, f"{home}/table", ROW, ["id"], ["seq"], 4)
    t.apply(spark.createDataFrame([("+I", 1, 5, 5), ("+I", 2, 6, 5), ("+I", None, 7, 5), ("-D", 4, 1, 5)], FEED), 0)
    t.apply(spark.createDataFrame([("+U", 1, 8, 6)], FEED), 1)
    batch = spark.createDataFrame([("+U", 1, 9, 7), ("-D", 2, 6, 8), ("+U", None, 3, 4), ("+I", 3, 1, 1), ("+U", 4, 2, 9)], FEED)
    staged = t.stage(batch, 2)
    small = sorted(map(str, t.images(staged).collect()))
    monkeypatch.setattr(versioned, "BROADCAST_BYTES", 0)
    large = t.images(staged)
    assert sorted(map(str, large.collect())) == small and len(small) == 5
    assert plan_of(t.images(staged)).count("Exchange hashpartitioning") == 1
    first = KeyedTable(spark, f"{home}/first", ROW, ["id"], ["seq"], 4)
    assert "Exchange" not in plan_of(first.images(first.stage(batch, 0)))


def test_topic_tasks_follow_the_batch(spark, home):
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "12"}
    before = {n: spark.conf.get(n) for n in names}
    for n, value in names.items():
        spark.conf.set(n, value)
    try:
        sinks.topic_writer(home, ["id"], ["id", "qty"], ["seq"], 2)(numbered(spark, 500, 1), 0)
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
    written = spark.read.parquet(f"{home}/batch=0")
    assert len([n for n in os.listdir(f"{home}/batch=0") if n.endswith(".parquet")]) > 2
    assert written.count() == 500 and written.select("partition").distinct().count() == 2


def test_ends_are_read_in_one_shuffle(spark, home):
    ends = MaintainedEnds(spark, home, columns("g:string t:long item:long"), ["g"], ["t"], 2, 2)
    rows = spark.createDataFrame([("+I", g, t, t) for g in ("a", None) for t in range(6)], "op string, g string, t long, item long")
    ends.apply(rows, rows.limit(0).drop("op"), 0)
    ends.apply(rows.filter("t < 2").withColumn("op", F.lit(C.DELETE)), rows.drop("op"), 1)
    assert plan_of(ends.rows()).count("Exchange") == 1 and "Join" not in plan_of(ends.rows())
    assert {(r.g, r.n_rows, r["first"].t, r["last"].t) for r in ends.rows().collect()} == {("a", 4, 2, 5), (None, 4, 2, 5)}


def test_keyed_records_are_decoded_in_one_step(spark):
    key, value, order = columns("id:long"), columns("id:long qty:int"), columns("seq:long")
    texts = [('{"id":1}', '{"id":1,"qty":5}', '{"seq":7}'), ('{"id":2}', None, '{}'), ('{"id":3}', '{"qty": ', '{"seq":1}'),
             ("{broken", '{"qty":1}', '{"seq":1}'), ('{"id":4}', '{"qty":2}', '{"seq": '), ('{"id":5}', '{"qty":3}', ' { "seq":2}'),
             ('{"id":6}', '{"qty":4}', None), (None, '{"qty":4}', None), ('{"id":7}', '{"qty":4}', '{"seq":"x"}')]
    records = spark.createDataFrame(texts, "key string, value string, order string") \
        .withColumns({"timestamp": F.lit("2024-01-01").cast("timestamp"), "offset": F.lit(1)})
    changes = feeds.keyed_changes(records, key, value, order)
    assert plan_of(changes).count("Generate ") == 1
    assert sorted((r.id, r.op, r.qty, r.record_order and tuple(r.record_order)) for r in changes.collect()) == [
        (1, "+U", 5, (7,)), (2, "-D", None, None), (4, "+U", 2, None), (5, "+U", 3, (2,)), (6, "+U", 4, None), (7, "+U", 4, (None,))]
    assert {r.id for r in feeds.keyed_changes(records, key, value).filter("record_order IS NULL").collect()} == {1, 2, 4, 5, 6, 7}
