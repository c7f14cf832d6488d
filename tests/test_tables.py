"""Keyed tables and the maintained view: replays, failures, late changes, compaction."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark import files
from tidemark.operators import star
from tidemark.schemas import STORE_DIM, columns
from tidemark.session import work_dir
from tidemark.sources import feeds, sinks
from tidemark.sources.feeds import topic_records
from tidemark.sources.sinks import BatchNumber, topic_writer
from tidemark.streaming import versioned
from tidemark.streaming.keyed import KeyedTable
from tidemark.streaming.view import MaintainedView, apply_to_both

ROW = columns("id:long qty:int seq:long")
FEED = "op string, id long, qty int, seq long"


def table(spark, home, buckets=4):
    return KeyedTable(spark, f"{home}/table", ROW, ["id"], ["seq"], buckets)


def state(t):
    return sorted((r.id, r.qty) for r in t.rows().collect())


def test_batches_replays_and_late_changes(spark, home):
    t = table(spark, home)
    assert state(t) == []
    assert t.apply(spark.createDataFrame([("+I", 1, 5, 1), ("+I", 2, 6, 2), ("+I", 3, 7, 3)], FEED), 0)
    assert not t.apply(spark.createDataFrame([("+I", 1, 99, 99)], FEED), 0)
    assert t.apply(spark.createDataFrame([("+U", 1, 10, 9), ("-D", 2, 0, 8)], FEED), 1)
    assert state(t) == [(1, 10), (3, 7)]
    t.table.compact()
    assert t.apply(spark.createDataFrame([("+U", 1, 11, 5), ("+U", 2, 12, 4), ("-D", 3, 0, 1)], FEED), 2)
    assert state(t) == [(1, 10), (3, 7)]  # all of these were older
    assert t.apply(spark.createDataFrame([("+I", 2, 13, 20)], FEED), 3)
    assert state(t) == [(1, 10), (2, 13), (3, 7)]


def test_a_batch_counts_from_its_commit(spark, home):
    t = table(spark, home)
    t.apply(spark.createDataFrame([("+I", 1, 5, 1)], FEED), 0)
    staged = t.stage(spark.createDataFrame([("+U", 1, 6, 2), ("+I", 2, 7, 3)], FEED), 1)
    assert state(t) == [(1, 5)]
    t.table.commit(staged)
    assert state(t) == [(1, 6), (2, 7)]


def test_a_failing_batch_leaves_no_trace(spark, home):
    t = table(spark, home)
    t.apply(spark.createDataFrame([("+I", 1, 5, 1)], FEED), 0)
    broken = spark.range(1).select(F.lit("+U").alias("op"), F.lit(1).cast("long").alias("id"),
                                   F.raise_error(F.lit("boom")).cast("int").alias("qty"), F.lit(2).cast("long").alias("seq"))
    with pytest.raises(Exception, match="boom"):
        t.apply(broken, 1)
    assert state(t) == [(1, 5)] and t.table.manifest().last_batch == 0


@pytest.mark.parametrize("broadcast_bytes", [2**26, 0])
def test_random_feed_with_a_hot_key(spark, home, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(versioned, "BROADCAST_BYTES", broadcast_bytes)  # 0: always join with a shuffle
    rng, want, t = random.Random(1), {}, table(spark, home, 8)
    seq = 0
    for batch_id in range(5):
        rows = []
        for _ in range(300):
            seq += 1
            key = 7 if rng.random() < .4 else rng.randrange(60)
            op = "-D" if rng.random() < .2 else "+U"
            rows.append((op, key, seq * 2, seq))
            want.pop(key, None) if op == "-D" else want.__setitem__(key, seq * 2)
        rng.shuffle(rows)
        t.apply(spark.createDataFrame(rows, FEED), batch_id)
        assert state(t) == sorted(want.items())
        if batch_id % 2:
            t.table.compact()
        assert state(t) == sorted(want.items())


def test_compaction_rewrites_touched_buckets_only(spark, home):
    t = table(spark, home, 8)
    t.apply(spark.range(200).select(F.lit("+I").alias("op"), "id", F.lit(1).alias("qty"), F.lit(1).cast("long").alias("seq")), 0)
    t.table.compact()
    before = t.table.manifest().buckets
    t.apply(spark.createDataFrame([("+U", 5, 2, 2)], FEED), 1)
    touched, = t.table.manifest().batches.values()
    t.table.compact()
    after = t.table.manifest().buckets
    assert len(before) == 8 and len(touched) == 1
    assert {b for b in before if before[b] != after[b]} == {str(touched[0])}
    gone = t.table.vacuum()
    assert gone and len(t.rows().collect()) == 200 and dict(state(t))[5] == 2
    assert len(files.names(spark, f"{home}/table/manifests")) == 1  # old manifests go as well
    t.apply(spark.createDataFrame([("+U", 5, 3, 3)], FEED), 2)
    assert dict(state(t))[5] == 3


def test_large_buckets_are_written_by_several_tasks(spark, home, monkeypatch):
    monkeypatch.setattr(versioned, "TASK_BYTES", 2000)
    rows = spark.range(20_000).select(F.lit("+I").alias("op"), "id", F.hash("id").alias("qty"), F.lit(1).cast("long").alias("seq"))
    t = table(spark, home, 2)
    t.apply(rows, 0)
    t.apply(rows.withColumn("seq", F.lit(2).cast("long")), 1)
    t.table.compact()
    stored = t.table.manifest().buckets
    assert len(stored) == 2 and all(len([n for n in files.names(spark, f) if n.endswith(".parquet")]) > 4 for f in stored.values())
    assert t.rows().count() == 20_000 and t.rows().agg(F.min("seq")).first()[0] == 2


def test_compaction_shuffles_once_and_a_single_batch_is_not_merged(spark, home):
    t = table(spark, home, 4)
    rows = spark.range(100).select(F.lit("+I").alias("op"), "id", F.lit(1).alias("qty"), F.lit(1).cast("long").alias("seq"))
    t.apply(rows, 0)
    plan = t.rows()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    parts = [versioned._BUCKET, versioned._SHARE]
    spread = t.table._read(list(t.table.manifest().batches)).withColumns({p: F.pmod("id", F.lit(2)).cast("int") for p in parts})
    plan = t.table.merge(spread.repartition(8, *parts), parts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_ties_end_alike_in_one_batch_and_in_two(spark, home):
    rows = [("+U", 1, 5, 1), ("+U", 1, 9, 1), ("+U", 1, 7, 1), ("+U", 2, 4, 1), ("-D", 2, 4, 1)]
    together, apart, back = (table(spark, f"{home}/{n}") for n in "abc")
    together.apply(spark.createDataFrame(rows, FEED), 0)
    for n, row in enumerate(rows):
        apart.apply(spark.createDataFrame([row], FEED), n)
        back.apply(spark.createDataFrame([rows[-1 - n]], FEED), n)
    assert state(together) == state(apart) == state(back) == [(1, 9)]


def test_images_and_stored_rows_settle_ties_alike(spark, home):
    t = table(spark, home)
    t.apply(spark.createDataFrame([("+U", 1, 9, 1)], FEED), 0)
    staged = t.stage(spark.createDataFrame([("+U", 1, 5, 1), ("+U", 3, 1, 1)], FEED), 1)
    assert [(r.op, r.id) for r in t.images(staged).collect()] == [("+U", 3)]
    t.table.commit(staged)
    assert state(t) == [(1, 9), (3, 1)]


def test_second_writer_cannot_publish_the_same_version(spark, home):
    files.publish_text(spark, f"{home}/m/1.json", "{}")
    with pytest.raises(FileExistsError):
        files.publish_text(spark, f"{home}/m/1.json", "{}")
    assert files.read_text(spark, f"{home}/m/1.json") == "{}"


FACT = columns("ss_store_sk:int ss_sold_date_sk:int ss_ticket_number:long ss_quantity:int"
               " ss_net_paid_inc_tax:amount ss_net_profit:amount")
LINE = columns("id:long seq:long ss_store_sk:int ss_sold_date_sk:int ss_ticket_number:long ss_quantity:int"
               " ss_net_paid_inc_tax:amount ss_net_profit:amount")


@pytest.fixture
def dims(spark):
    day = spark.createDataFrame([(k,) for k in range(2460311, 2460314)], "d_date_sk int").select(
        "d_date_sk", F.date_from_unix_date(F.col("d_date_sk") - 2440588).alias("d_date"))
    stores = spark.createDataFrame([(s, f"store {s}", "CA", "Ann") for s in (1, 2, 3)], STORE_DIM)
    return day, stores


def view_rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("broadcast_bytes", [2**26, 0])
def test_view_equals_recompute_after_every_batch(spark, home, dims, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(versioned, "BROADCAST_BYTES", broadcast_bytes)
    keyed = KeyedTable(spark, f"{home}/fact", LINE, ["id"], ["seq"], 4)
    view = MaintainedView(spark, f"{home}/view", FACT, 4)
    rng, seq = random.Random(2), 0
    from decimal import Decimal
    money = lambda: rng.choice([None, Decimal(rng.randrange(-500, 500)) / 100])
    for batch_id in range(5):
        rows = []
        for _ in range(80):
            seq += 1
            # store 1 takes a third; store 4, day 2460315 and NULL keys have no dimension row
            rows.append((rng.choice(["+I", "+U", "-D"]), rng.choice([None, *range(40)]), seq,
                         1 if rng.random() < .34 else rng.choice([2, 3, 4, None]), rng.choice([2460311, 2460312, 2460315, None]),
                         rng.choice([None, seq]), rng.choice([None, 3]), money(), money()))
        schema = "op string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LINE.fields)
        batch = spark.createDataFrame(rows, schema)
        assert apply_to_both(batch, batch_id, keyed, view)
        assert not apply_to_both(batch, batch_id, keyed, view)
        if batch_id == 2:
            keyed.table.compact()
            view.sums.compact()
        assert view_rows(view.rows(*dims)) == view_rows(star.daily_store_view(keyed.rows(), *dims))


def test_streams_with_a_new_checkpoint_lose_nothing(spark, home):
    t = table(spark, home)
    first, second = BatchNumber(0, "first"), BatchNumber(0, "second")
    assert t.apply(spark.createDataFrame([("+I", 1, 5, 1)], FEED), first)
    assert t.apply(spark.createDataFrame([("+I", 2, 6, 2)], FEED), second)
    assert not t.apply(spark.createDataFrame([("+I", 3, 9, 3)], FEED), second)
    assert state(t) == [(1, 5), (2, 6)]
    write = topic_writer(f"{home}/topic", ["id"], ["id", "qty"], ["seq"], 2)
    for batch, row in ((first, ("+I", 1, 5, 1)), (second, ("+I", 2, 6, 2)), (second, ("+I", 2, 6, 2))):
        write(spark.createDataFrame([row], FEED), batch)
    assert topic_records(spark, f"{home}/topic").count() == 2


def sales(spark, *rows):
    return spark.createDataFrame(list(rows), "op string, ss_store_sk int, ss_sold_date_sk int, ss_ticket_number long,"
                                 " ss_quantity int, ss_net_paid_inc_tax decimal(18,4), ss_net_profit decimal(18,4)")


def test_groups_vanish_and_unknown_measures_stay_unknown(spark, home, dims):
    from decimal import Decimal
    view = MaintainedView(spark, home, FACT, 2)
    view.apply(sales(spark, ("+I", 1, 2460311, 10, 2, Decimal(5), None), ("+I", 2, 2460311, 11, 1, Decimal(7), Decimal(1))), 0)
    view.apply(sales(spark, ("-D", 1, 2460311, 10, 2, Decimal(5), None), ("+I", 1, 2460312, None, None, None, Decimal(3))), 1)
    got = {(r.ss_store_sk, r.sold_date_sk.day): (r.total_sales_amount, r.total_net_profit, r.total_items_sold, r.transaction_count)
           for r in view.rows(*dims).collect()}
    assert got == {(2, 1): (Decimal(7), Decimal(1), 1, 1), (1, 2): (None, Decimal(3), None, 0)}


def test_rebuild_between_two_batches(spark, home, dims):
    from decimal import Decimal
    keyed = KeyedTable(spark, f"{home}/fact", LINE, ["id"], ["seq"], 2)
    view = MaintainedView(spark, f"{home}/view", FACT, 2)
    schema = "op string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LINE.fields)
    for number in range(3):
        batch = spark.createDataFrame([("+I", number, number, 1, 2460311, 10, 2, Decimal(5), Decimal(1))], schema)
        apply_to_both(batch, BatchNumber(number, "feed"), keyed, view)
        if number == 1:
            view.rebuild(keyed.rows(), keyed)
        assert view_rows(view.rows(*dims)) == view_rows(star.daily_store_view(keyed.rows(), *dims))


def test_dimension_changes_show_without_reading_facts_again(spark, home, dims):
    from decimal import Decimal
    day, stores = dims
    view = MaintainedView(spark, home, FACT, 2)
    view.apply(sales(spark, ("+I", 1, 2460311, 10, 2, Decimal(5), None), ("+I", 9, 2460311, 10, 2, Decimal(5), None)), 0)
    assert [r.s_state for r in view.rows(day, stores).collect()] == ["CA"]
    moved = spark.createDataFrame([(1, "store 1", "NV", "Bob"), (9, "store 9", "TX", "Cy")], STORE_DIM)
    assert sorted(r.s_state for r in view.rows(day, moved).collect()) == ["NV", "TX"]


def test_crash_between_view_and_table(spark, home, dims):
    """The view has the batch, the table does not: the repeated batch must reach the table only."""
    from decimal import Decimal
    keyed = KeyedTable(spark, f"{home}/fact", LINE, ["id"], ["seq"], 2)
    view = MaintainedView(spark, f"{home}/view", FACT, 2)
    schema = "op string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LINE.fields)
    batch = spark.createDataFrame([("+I", 1, 1, 1, 2460311, 10, 2, Decimal(5), Decimal(1))], schema)
    staged = keyed.stage(batch, 0)
    view.apply(keyed.images(staged), 0)
    assert apply_to_both(batch, 0, keyed, view)
    assert view_rows(view.rows(*dims)) == view_rows(star.daily_store_view(keyed.rows(), *dims))
    assert view.rows(*dims).first().total_items_sold == 2


def test_joining_after_summing_equals_summing_after_joining(spark, dims):
    day, stores = dims
    doubled = stores.unionByName(stores)  # even if a dimension repeats a key
    from decimal import Decimal
    facts = sales(spark, *[("+I", i % 4, 2460311 + i % 5, i, i, Decimal(i), Decimal(-i)) for i in range(100)]).drop("op")
    direct = star.star_join(facts, day, doubled).groupBy("ss_store_sk", "d_date").agg(
        F.sum("ss_quantity").alias("q"), F.count("ss_ticket_number").alias("n"))
    got = star.daily_store_view(facts, day, doubled)
    assert sorted((r.ss_store_sk, r.sold_date_sk, r.total_items_sold, r.transaction_count) for r in got.collect()) == \
        sorted((r.ss_store_sk, r.d_date, r.q, r.n) for r in direct.collect())


def test_targets_in_the_catalog(spark):
    sinks.create_target(spark, "tide_test.sales", ROW)
    spark.createDataFrame([(1, 2, 3)], ROW).write.insertInto("tide_test.sales")
    sinks.create_target(spark, "tide_test.sales", ROW)  # there already: kept
    assert spark.table("tide_test.sales").count() == 1
    sinks.copy_into(spark.createDataFrame([(7, 8, 9)], ROW), "tide_test.sales")
    assert spark.table("tide_test.sales").count() == 2
    assert sinks.clone_shape(spark.table("tide_test.sales")).schema.names == ROW.names
    sinks.create_target(spark, "tide_test.sales", ROW, recreate=True)
    assert spark.table("tide_test.sales").count() == 0


def test_bucketed_target_joins_and_groups_without_a_shuffle(spark):
    sinks.create_target(spark, "tide_test.any", ROW)
    rows = spark.range(1000).select("id", (F.col("id") % 9).cast("int").alias("qty"))
    sinks.create_bucketed(rows, "tide_test.bucketed", "id", 4)
    t = spark.table("tide_test.bucketed")
    plan = t.groupBy("id").count().join(t.hint("merge"), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and t.count() == 1000


def test_jdbc_and_kafka_options():
    o = feeds.jdbc_snapshot_options("jdbc:x", "store_sales", "id", 1, 81_920)
    assert (o["numPartitions"], o["lowerBound"], o["upperBound"]) == ("10", "1", "81921")
    assert feeds.jdbc_snapshot_options("jdbc:x", "t", "id", 1, 10**12)["numPartitions"] == "10000"
    assert sinks.jdbc_write_options("jdbc:x", "t")["batchsize"] == "1000"
    assert feeds.kafka_options("b:1", "t")["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        feeds.kafka_options("b:1", "t", "middle")


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, name, default=None):
        return self.value if name == "spark.checkpoint.dir" and self.value else default


class _Session:
    """Just what work_dir asks of a session."""
    def __init__(self, folder, master):
        self.conf = _Conf(folder)
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})


def test_shared_folder_comes_from_the_session():
    assert work_dir(_Session("hdfs://shared/dir/", "yarn")) == "hdfs://shared/dir"
    assert work_dir(_Session("/shared", "local[2]")) == "/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(_Session(None, "yarn"))
