"""Chunked snapshots, several watermarks, digests, look-ups, layouts, profiles per load, kept ends."""

import datetime
import os
import random
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemark.operators import lookup, star
from tidemark.operators.digests import digest_diff, stretches
from tidemark.operators.loads import error_bound, merge_profiles, profile_loads
from tidemark.operators.pairs import returned_sales
from tidemark.operators.quality import reconcile
from tidemark.operators.snapshots import KeyChunks, chunked_snapshot, key_chunks
from tidemark.operators.windows import item_trends, with_event_time
from tidemark.operators.changes import materialize
from tidemark.schemas import columns
from tidemark.sources import feeds, sinks
from tidemark.sources.sinks import BatchNumber
from tidemark.streaming import jobs
from tidemark.streaming.ends import MaintainedEnds
from tidemark.streaming.metrics import batch_rows, batches, open_groups
from tidemark.streaming.snapshots import SnapshotStream

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- chunked snapshots -------------------------------------------------------------------------

def test_chunk_numbers_and_ranges_agree(spark):
    chunks = KeyChunks("k", -5, 10, 4)
    rows = spark.createDataFrame([(k,) for k in [None, -2**63, -6, -5, 4, 5, 24, 25, 34, 35, 99, 2**63 - 1]], "k long")
    numbered = {r.k: r.n for r in rows.select("k", chunks.number().alias("n")).collect()}
    assert numbered[-5] == 0 and numbered[5] == 1 and numbered[25] == 3 and numbered[None] == 0 and numbered[2**63 - 1] == 3
    for first in range(5):
        for until in range(6):
            found = {r.k for r in rows.filter(chunks.between(first, until)).collect()}
            assert found == {k for k, n in numbered.items() if first <= n < until}, (first, until)


def test_key_chunks_cover_the_keys(spark):
    assert key_chunks(spark.range(1000).toDF("k"), "k", 100) == KeyChunks("k", 0, 100, 10)
    assert key_chunks(spark.range(1000).toDF("k"), "k", 1, most=7).count == 7
    assert key_chunks(spark.range(0).toDF("k"), "k") == KeyChunks("k", 0, 1, 1)


FEED = "op string, seq long, k long, v string"


def test_changes_within_the_bracket_replace_what_was_read(spark):
    """Chunk 0 (keys below 10) was read between 10 and 20, chunk 1 between 30 and 40."""
    chunks = KeyChunks("k", 0, 10, 2)
    brackets = spark.createDataFrame([(0, 10, 20), (1, 30, 40)], "chunk int, low long, high long")
    changes = spark.createDataFrame([
        ("+I", 5, 1, "old"), ("+U", 15, 1, "new"),          # read before 15: the bracket has the newer one
        ("+I", 6, 2, "x"), ("-D", 16, 2, "x"),              # read before 16: deleted within
        ("+I", 17, 3, "late"),                              # not there when it was read
        ("+I", 7, 4, "a"), ("+U", 18, 4, "b"), ("-U", 19, 4, "b"), ("+U", 19, 4, "c"), ("+U", 25, 4, "d"),  # goes on after it
        ("+I", 8, 11, "y"), ("+U", 25, 11, "z"),            # chunk 1 read it when it was z
        ("+I", 9, 12, "g"), ("-D", 35, 12, "g"), ("+I", 45, 12, "again")], FEED)
    read = spark.createDataFrame([(1, "old"), (2, "x"), (4, "b"), (11, "z"), (12, "g")], "k long, v string")
    feed = chunked_snapshot(read, changes, brackets, chunks, ["k"], ["seq"])
    assert sorted(map(tuple, feed.collect())) == sorted([
        ("+I", 20, 1, "new"), ("+I", 20, 3, "late"), ("+I", 20, 4, "c"), ("+U", 25, 4, "d"), ("+I", 40, 11, "z"), ("+I", 45, 12, "again")])
    state = materialize(feed, ["k"], ["seq"]).select("k", "v")
    assert sorted(map(tuple, state.collect())) == [(1, "new"), (3, "late"), (4, "d"), (11, "z"), (12, "again")]
    nothing = chunked_snapshot(read.limit(0), changes.limit(0), brackets, chunks, ["k"], ["seq"])
    assert nothing.count() == 0


def test_chunked_snapshot_reads_the_feed_a_bounded_number_of_times(spark):
    """However many chunks: the rows and the changes are each read once (and once for the changes within)."""
    plan = plan_of(contract.queries()["chunked_snapshot"](spark, SF_DIR))
    assert plan.count("FileScan") <= 4 and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_snapshot_stream_repeats_a_batch_alike(spark, home):
    table = {0: [(1, 1, "a"), (2, 1, "b"), (11, 1, "c")]}
    row = "k long, seq long, v string"
    snapshot = SnapshotStream(spark, home, KeyChunks("k", 0, 10, 2), 1, lambda first, until: spark.createDataFrame(
        table[0], row).filter(KeyChunks("k", 0, 10, 2).between(first, until)), ["k"], ["seq"])
    out = []
    write = snapshot.writer(lambda df, n: out.append(sorted(map(tuple, df.collect()))))
    def batch(*rows):
        return spark.createDataFrame(list(rows), "op string, k long, seq long, v string")
    write(batch(("+I", 1, 1, "a"), ("+I", 11, 1, "c")), BatchNumber(0, "s"))
    assert out[-1] == [] and not snapshot.done(0)  # nothing is read yet, so nothing is handed on
    table[0] = [(1, 2, "a2"), (11, 1, "c")]  # 2 is deleted meanwhile
    changes = batch(("+U", 1, 2, "a2"), ("-D", 2, 2, "b"), ("+I", 3, 2, "n"), ("+U", 11, 2, "c2"))
    write(changes, BatchNumber(1, "s"))
    write(changes, BatchNumber(1, "s"))
    assert out[-1] == out[-2] == [("+I", 3, 2, "n"), ("+U", 1, 2, "a2"), ("-D", 2, 2, "b")]
    assert snapshot.left(1).count() == 1 and not snapshot.done(1)
    write(batch(("+U", 1, 3, "a3")), BatchNumber(2, "s"))
    assert out[-1] == [("+I", 11, 1, "c"), ("+U", 1, 3, "a3")] and snapshot.done(2)
    write(batch(("+U", 11, 4, "c4")), BatchNumber(3, "s"))
    assert out[-1] == [("+U", 11, 4, "c4")]


def test_latest_start_counts_files_of_the_same_millisecond(spark, home):
    schema = columns("n:long")
    def put(name, n, when):
        spark.range(n, n + 1).toDF("n").coalesce(1).write.parquet(f"{home}/{name}")
        part = next(f for f in os.listdir(f"{home}/{name}") if f.endswith(".parquet"))
        os.makedirs(f"{home}/in", exist_ok=True)
        os.rename(f"{home}/{name}/{part}", f"{home}/in/{name}.parquet")
        os.utime(f"{home}/in/{name}.parquet", (when, when))
    def run():
        stream = feeds.from_now_on(spark, f"{home}/in", schema, f"{home}/own")
        jobs.append_to_parquet(stream, f"{home}/out", "latest", f"{home}/checkpoint", availableNow=True).awaitTermination()
        return sorted(r.n for r in spark.read.schema(schema).parquet(f"{home}/out").collect())
    now = int(time.time())
    put("a", 1, now - 100), put("b", 2, now)
    assert run() == []
    put("c", 3, now)
    assert run() == [3]
    put("d", 4, now + 5)
    assert run() == [3, 4]


# -- streams -----------------------------------------------------------------------------------

def at(minute):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute)


SALE = "id long, store_sk int, item_sk long, ext_sales_price double, net_profit double, created_at timestamp_ntz"


def test_chained_windows_update_less_state(spark, home):
    """Batches of a minute, slides of five, windows of thirty: six updates of a key, or one."""
    rnd = random.Random(1)
    for minute in range(15):
        rows = [(n, 1, rnd.randint(1, 40), 1.0, 0.0, at(minute)) for n in range(100)]
        spark.createDataFrame(rows, SALE).coalesce(1).write.mode("append").parquet(f"{home}/in")
        for name in os.listdir(f"{home}/in"):
            if name.endswith(".parquet") and os.path.getmtime(f"{home}/in/{name}") > 1_700_000_100:
                os.utime(f"{home}/in/{name}", (1_700_000_000 + minute, 1_700_000_000 + minute))
    updates, out = {}, {}
    for chained in (False, True):
        stream = with_event_time(feeds.file_stream(spark, f"{home}/in", spark.read.parquet(f"{home}/in").schema, maxFilesPerTrigger="1"))
        trend = item_trends(stream, size="30 minutes", slide="5 minutes", chained=chained)
        job = jobs.append_to_parquet(trend, f"{home}/out{chained}", "t", f"{home}/c{chained}", availableNow=True)
        job.awaitTermination()
        updates[chained] = sum(b["state_updates"] for b in batches(job))
        out[chained] = sorted(map(tuple, spark.read.parquet(f"{home}/out{chained}").collect()))
    assert out[True] == out[False] and len(out[True]) > 50
    assert updates[True] * 2 < updates[False]
    with pytest.raises(ValueError):
        item_trends(stream, size="1 hour", slide="7 minutes", chained=True)


def test_returned_sales_bounds(spark):
    day = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n)
    sales = spark.createDataFrame([(1, 1, day(0)), (1, 2, day(0)), (2, 1, day(5)), (None, 1, day(0))],
                                  "ss_ticket_number long, ss_item_sk long, sold_at timestamp")
    returns = spark.createDataFrame(
        [(1, 1, day(0)), (1, 1, day(30)), (1, 1, day(31)), (2, 1, day(4)), (None, 1, day(1))],
        "sr_ticket_number long, sr_item_sk long, returned_at timestamp")
    out = returned_sales(sales, returns).select("ss_ticket_number", "ss_item_sk", "returned_at").collect()
    assert sorted(((r[0] or 0), r[1], r[2]) for r in out if r[2]) == [(1, 1, day(0)), (1, 1, day(30))]
    assert sorted((r[0] or 0, r[1]) for r in out if not r[2]) == [(0, 1), (1, 2), (2, 1)]


def test_watermark_policy_is_set_for_the_start_only(spark):
    seen = []
    before = spark.conf.get(jobs.WATERMARK_POLICY)
    jobs.with_watermark_policy(spark, "max", lambda: seen.append(spark.conf.get(jobs.WATERMARK_POLICY)))
    assert seen == ["max"] and spark.conf.get(jobs.WATERMARK_POLICY) == before
    with pytest.raises(ValueError):
        jobs.with_watermark_policy(spark, "mean", lambda: None)


def test_batches_as_rows_and_open_groups(spark, home):
    spark.createDataFrame([(n, n % 2, 1, 1.0, 0.0, at(n)) for n in range(10)], SALE).write.parquet(f"{home}/in")
    stream = with_event_time(feeds.file_stream(spark, f"{home}/in", spark.read.parquet(f"{home}/in").schema))
    counted = stream.observe("seen", F.count("*").alias("rows"), F.max("store_sk").alias("most")).groupBy(
        F.window("event_time", "1 minute"), "store_sk").count()
    job = jobs.append_to_parquet(counted, f"{home}/out", "t", f"{home}/c", availableNow=True)
    job.awaitTermination()
    table = batch_rows(spark, batches(job))
    assert table.agg(F.sum("rows_in"), F.sum("late_groups")).first() == (10, 0)
    assert max(r.observed["seen"]["rows"] for r in table.collect() if r.rows_in) == 10
    closed = spark.read.parquet(f"{home}/out").count()
    assert open_groups(spark, f"{home}/c").count() == 10 - closed > 0


# -- digests -----------------------------------------------------------------------------------

def table_of(spark, rows, kind="long"):
    return spark.createDataFrame(rows, f"k {kind}, n int, v string")


def alike(spark, left, right, keys, **sizes):
    wanted = reconcile(left, right, keys, left.columns).filter("status <> 'same'")
    found = digest_diff(left, right, keys, left.columns, **sizes)
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    return found.count()


@pytest.mark.parametrize("kind", ["long", "string"])
def test_digest_diff_is_the_full_comparison(spark, kind):
    rnd = random.Random(kind)
    rows = [(k, n, str(rnd.random())) for k in range(700) for n in range(rnd.randint(1, 3))]
    rows += [(5, n, "hot") for n in range(1500)] + [(None, 1, None), (None, 1, None)]
    changed = [r if rnd.random() > 0.01 else (r[0], r[1], None) for r in rows if rnd.random() > 0.005] + [(900, 1, "n"), (-3, 1, "m")]
    as_key = lambda some: [(None if k is None else k if kind == "long" else f"key{k}", n, v) for k, n, v in some]
    left, right = table_of(spark, as_key(rows), kind), table_of(spark, as_key(changed), kind)
    for sizes in ({}, {"ranges": 4, "leaf_rows": 2}, {"ranges": 1, "leaf_rows": 1000}):
        assert alike(spark, left, right, ["k", "n"], **sizes) > 10
    assert alike(spark, left, left.repartition(3), ["k", "n"]) == 0
    none = left.limit(0)
    assert alike(spark, none, none, ["k", "n"]) == 0
    assert alike(spark, left, none, ["k", "n"]) > 1000


def test_digest_diff_reads_and_shuffles_what_differs(spark, home):
    rows = spark.range(200_000).select(F.col("id").alias("k"), F.lit(1).alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    sinks.write_by_key(rows, f"{home}/a", ["k"], 4)
    sinks.write_by_key(rows.withColumn("v", F.when(F.col("k").between(70_000, 70_009), "x").otherwise(F.col("v"))), f"{home}/b", ["k"], 4)
    found = digest_diff(spark.read.parquet(f"{home}/a"), spark.read.parquet(f"{home}/b"), ["k"], ["k", "n", "v"])
    plan = plan_of(found)
    assert sorted(r.k for r in found.collect()) == list(range(70_000, 70_010))
    assert "GreaterThanOrEqual(k," in plan and "LessThan(k," in plan and plan.count("Exchange hashpartitioning") == 1


def test_stretches():
    assert stretches([3, 1, 2, 7, 9], 9) == [(1, 4), (7, 8), (9, 10)]
    assert stretches([1, 2, 3, 7, 9], 2) == [(1, 4), (7, 10)]
    assert stretches(range(0, 200, 2), 1) == [(0, 199)]
    assert stretches([]) == []


# -- look-ups ----------------------------------------------------------------------------------

def test_key_ranges_hold_all_keys(spark):
    rnd = random.Random(4)
    keys = [rnd.randint(0, 50) for _ in range(30)] + [rnd.randint(10**12, 10**12 + 9) for _ in range(30)] + [-7]
    wanted = spark.createDataFrame([(k,) for k in [*keys, None]], "k long")
    for most in (1, 2, 5, 64):
        ranges = lookup.key_ranges(wanted, "k", most)
        assert 0 < len(ranges) <= most and all(any(a <= k <= b for a, b in ranges) for k in keys)
    assert [a for a, _ in lookup.key_ranges(wanted, "k", 2)] == [-7, min(k for k in keys if k > 99)]
    assert lookup.key_ranges(wanted.filter("k is null"), "k") == []
    texts = spark.createDataFrame([("b",), ("a",)], "k string")
    assert lookup.key_ranges(texts, "k") == [("a", "b")]


def scanned(df):
    """Rows that the file scans of a plan gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan
    leaves = plan.collectLeaves()
    found = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        while leaf.nodeName().endswith("QueryStage"):
            leaf = leaf.plan().collectLeaves().apply(0)
        if "Scan parquet" in leaf.nodeName():
            found.append(leaf.metrics().apply("numOutputRows").value())
    return max(found)


def test_lookups_skip_what_cannot_match(spark, home):
    rows = spark.range(300_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    sinks.write_by_key(rows, f"{home}/t", ["k"], 3, distinct=100_000)
    table = spark.read.parquet(f"{home}/t")
    wanted = spark.createDataFrame([(k,) for k in [None, 5, 6, 150_000, 299_999, 10**9]], "k long")
    found = lookup.rows_of_keys(table, wanted, ["k"])
    assert sorted(r.k for r in found.collect()) == [5, 6, 150_000, 299_999]
    assert scanned(found) <= 100_000  # a page of each
    near = lookup.rows_of_keys(table, spark.range(150_000, 150_100).toDF("k"), ["k"])
    assert near.count() == 100
    assert scanned(near) <= 60_000 < scanned(table.filter("n >= 0"))
    assert "BroadcastHashJoin" not in lookup.rows_of_keys(table, spark.range(1000).toDF("k"), ["k"], broadcast_bytes=10)._jdf \
        .queryExecution().optimizedPlan().toString()
    assert lookup.rows_of_keys(table, wanted.filter("k is null"), ["k"]).count() == 0


def test_a_dimension_of_long_texts_is_not_broadcast(spark):
    narrow = spark.range(1000).select("id", F.lit("x").alias("name"))
    wide = spark.range(1000).select("id", F.expr("repeat('x', 100000)").alias("name"))
    hinted = lambda df: "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(star.measured(narrow)) and not hinted(star.measured(wide))
    assert not hinted(star.measured(spark.range(3).select(F.array("id").alias("a"))))
    assert hinted(star.measured(narrow.limit(0)))


# -- layouts and profiles ----------------------------------------------------------------------

@pytest.mark.parametrize("name, joins", [("bucketed_join", 1), ("view_stored_by_store", 0)])
def test_bucketed_layouts_need_no_exchange(spark, name, joins):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables that are too large for it
    try:
        plan = plan_of(contract.queries()[name](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == joins


def test_profiles_of_any_span(spark):
    rows = spark.range(50_000).select((F.col("id") % 5).alias("load"), F.col("id").alias("k"),
                                      (F.xxhash64("id") % 20_000).alias("item"), F.lit("1.50").cast("decimal(7,2)").alias("amount"))
    kept = profile_loads(rows, "load", "k", "item", "amount")
    merged = merge_profiles(kept.filter("load between 1 and 3"), []).first()
    exact = rows.filter("load between 1 and 3").agg(F.count("*"), F.count_distinct("item"), F.min("k"), F.max("k"), F.sum("amount")).first()
    assert (merged.row_count, merged.min_key, merged.max_key, merged.total_amount) == (exact[0], exact[2], exact[3], exact[4])
    assert abs(merged.distinct_items - exact[1]) <= error_bound() * exact[1]
    assert error_bound(16) < error_bound(12) < 0.05


# -- kept ends ---------------------------------------------------------------------------------

ENDS_ROW = columns("g:string t:long item:string")


@pytest.mark.parametrize("keep", [1, 3])
def test_ends_of_groups_under_changes(spark, home, keep):
    rnd = random.Random(keep)
    ends = MaintainedEnds(spark, home, ENDS_ROW, ["g"], ["t"], keep, 2)
    table: list[tuple] = []
    for batch_id in range(5):
        before, images = list(table), []
        for _ in range(150):
            group = rnd.choice(["hot", "hot", "a", "b", None])  # a group with a large part of all changes
            mine = [r for r in table if r[0] == group]
            if mine and rnd.random() < (0.2 if batch_id == 0 else 0.55):
                # Deletes come from the outside in, so that ends run out.
                gone = rnd.choice([min, max])(mine, key=lambda r: (r[1], r[2] or ""))
                table.remove(gone)
                images.append(("-D", *gone))
            else:
                new = (group, rnd.randint(0, 60), rnd.choice(["x", "y"]))
                table += [new] * (2 if rnd.random() < 0.1 else 1)
                images += [("+I", *new)] * (len(table) - len(before) - len(images) + 2 * sum(i[0] == "-D" for i in images))
        changes = spark.createDataFrame(images, "op string, g string, t long, item string").repartition(3)
        stored = spark.createDataFrame(before, "g string, t long, item string")
        assert ends.apply(changes, stored, batch_id)
        assert not ends.apply(changes, stored, batch_id)
        found = {r.g: (r.n_rows, tuple(r["first"]), tuple(r["last"])) for r in ends.rows().collect()}
        wanted = {}
        for group in {r[0] for r in table}:
            mine = sorted((t, i) for g, t, i in table if g == group)
            wanted[group] = (len(mine), mine[0], mine[-1])
        assert found == wanted
    everything = spark.createDataFrame([("-D", *r) for r in table], "op string, g string, t long, item string")
    ends.apply(everything, spark.createDataFrame(table, "g string, t long, item string"), 5)
    assert ends.rows().count() == 0
