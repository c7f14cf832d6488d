"""Streaming queries against the same function on batch input, late rows, restarts, fan-out."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark import files
from tidemark.operators import changes as C, shapes, windows as X
from tidemark.operators.pairs import returned_sales
from tidemark.plans.queries import QUERIES
from tidemark.plans.stream_queries import _in_two_folders, _turns_in_two_folders
from tidemark.schemas import RETURN_EVENT, SALES_EVENT, columns
from tidemark.session import work_dir
from tidemark.sources import feeds, sinks
from tidemark.streaming import jobs
from tidemark.streaming.keyed import KeyedTable
from tidemark.streaming.pairs import PairedStreams

START = dt.datetime(2024, 1, 1, 10)


def sale(i, second, store=1, item=1, price=10.0):
    return {"id": i, "ss_store_sk": store, "ss_item_sk": item, "ss_ext_sales_price": price, "ss_net_profit": price / 4,
            "created_at": (START + dt.timedelta(seconds=second)).isoformat()}


def put(folder, n, rows):
    """One more file of JSON lines, with a later modification time than those before."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{n:04d}.txt"
    with open(path, "w") as f:
        f.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)
    os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


def text_stream(spark, folder):
    return feeds.file_stream(spark, folder, columns("value:string"), "text", maxFilesPerTrigger="1")


def run(df, home, name):
    jobs.append_to_parquet(df, f"{home}/out", name, f"{home}/ck", availableNow=True).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{home}/out")


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def feed_folder(home):
    folder = f"{home}/in"
    n = 0
    for part in range(4):
        put(folder, part, [sale(n + k, part * 150 + k * 3, store=k % 3, item=k % 7, price=1.25 * k) for k in range(50)])
        n += 50
    put(folder, 4, ["not json", {"id": 900, "created_at": START.isoformat()}])  # no store: not counted
    put(folder, 5, [sale(10_000, 1_000_000)])  # far in the future: closes every window before it
    return folder


@pytest.mark.parametrize("shape", ["tumbling", "hopping", "longer"])
def test_stream_equals_batch(spark, feed_folder, home, shape):
    operator = {"tumbling": X.sales_metrics, "hopping": X.item_trends,
                "longer": lambda df: X.sales_metrics(df, "5 minutes")}[shape]
    streamed = run(operator(shapes.as_sales(feeds.event_stream(text_stream(spark, feed_folder), SALES_EVENT))), home, f"eq_{shape}")
    batch = operator(shapes.as_sales(feeds.event_stream(spark.read.text(feed_folder), SALES_EVENT)))
    closed = batch.filter(F.col("window_start") < F.lit("2024-01-02").cast("timestamp"))
    assert rows(streamed) == rows(closed) and streamed.count() > 3


def test_windows_are_half_open_and_late_rows_are_dropped(spark, home):
    put(f"{home}/in", 0, [sale(1, 0), sale(2, 59.999)])
    put(f"{home}/in", 1, [sale(3, 60), sale(4, 64)])  # watermark after this: 59 s, first window still open
    put(f"{home}/in", 2, [sale(5, 30), sale(6, 66)])  # 30 s is late but its window is open
    put(f"{home}/in", 3, [sale(7, 67)])               # watermark 61 s: this batch emits window [0, 60)
    put(f"{home}/in", 4, [sale(8, 10)])               # its window is out already: dropped
    put(f"{home}/in", 5, [sale(9, 10_000)])
    out = run(X.sales_metrics(shapes.as_sales(feeds.event_stream(text_stream(spark, f"{home}/in"), SALES_EVENT))), home, "late")
    assert sorted((r.window_start.minute, r.total_sales, r.first_item_sk) for r in out.collect()) == [(0, 3, 1), (1, 4, 1)]


def test_restart_goes_on_where_it_stopped(spark, home):
    def again():
        events = shapes.as_sales(feeds.event_stream(text_stream(spark, f"{home}/in"), SALES_EVENT))
        return run(X.sales_metrics(events), home, "restart")
    put(f"{home}/in", 0, [sale(1, 0), sale(2, 70)])
    assert [r.total_sales for r in again().collect()] == [1]
    put(f"{home}/in", 1, [sale(3, 80)])
    assert again().count() == 1
    put(f"{home}/in", 2, [sale(4, 500)])
    assert sorted((r.window_start.minute, r.total_sales) for r in again().collect()) == [(0, 1), (1, 2)]
    assert again().count() == 2


def test_alerts_hold_counts_above_ten(spark, home):
    back = lambda i, second, store: {"id": i, "sr_store_sk": store, "sr_return_amt": 5.0, "sr_net_loss": 1.0,
                                     "created_at": (START + dt.timedelta(seconds=second)).isoformat()}
    put(f"{home}/in", 0, [back(i, i, 7) for i in range(11)] + [back(i, i, 8) for i in range(10)])
    put(f"{home}/in", 1, [back(99, 10_000, 9)])
    events = shapes.as_returns(feeds.event_stream(text_stream(spark, f"{home}/in"), RETURN_EVENT))
    alert, = run(X.return_alerts(events), home, "alerts").collect()
    assert alert.message == "商店 7 退货率异常：22.00000000%" and str(alert.value) == "22.00"
    assert alert.alert_time == START + dt.timedelta(minutes=5) and alert.alert_type == "HIGH_RETURN_RATE"


def test_running_count_in_complete_mode(spark, home):
    put(f"{home}/in", 0, [{"op": "+I"}, {"op": "+I"}, {"op": "+I"}])
    put(f"{home}/in", 1, [{"op": "-U"}, {"op": "+U"}, {"op": "-D"}])
    from tidemark.functions.codecs import decode_rows
    ops = decode_rows(text_stream(spark, f"{home}/in"), "value", columns("op:string"))
    q = C.running_count(ops).writeStream.outputMode("complete").format("memory").queryName("running") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("running").first().row_count == 2


ROW = columns("id:long qty:int seq:long")


def change_stream(spark, folder):
    from tidemark.functions.codecs import decode_rows
    return decode_rows(text_stream(spark, folder), "value", columns("op:string id:long qty:int seq:long"))


def test_fan_out_reads_once_and_survives_a_failing_target(spark, home):
    put(f"{home}/in", 0, [{"op": "+I", "id": 1, "qty": 5, "seq": 1}, {"op": "+I", "id": 2, "qty": 6, "seq": 2}])
    put(f"{home}/in", 1, [{"op": "+U", "id": 1, "qty": 10, "seq": 3}, {"op": "-D", "id": 2, "seq": 4}])
    keyed = KeyedTable(spark, f"{home}/table", ROW, ["id"], ["seq"], 4)
    topic = sinks.topic_writer(f"{home}/topic", ["id"], ROW.names, ["seq"], 4)
    failures = [1]

    def shaky(batch, batch_id):
        if batch_id == 1 and failures:
            failures.pop()
            raise RuntimeError("target is down")
        topic(batch, batch_id)

    def go():
        return jobs.fan_out(change_stream(spark, f"{home}/in"), {"table": jobs.table_writer(keyed), "topic": shaky},
                            "fan", f"{home}/ck", availableNow=True)
    with pytest.raises(Exception, match="target is down"):
        go().awaitTermination()
    go().awaitTermination()
    assert [(r.id, r.qty) for r in keyed.rows().collect()] == [(1, 10)]
    records = sorted((r.key, r.value) for r in feeds.topic_records(spark, f"{home}/topic").collect() if r.value)
    assert len(records) == 3 and records[1] == ('{"id":1}', '{"id":1,"qty":5,"seq":1}')
    assert keyed.table.manifest().last_batch == 1


def test_domains_run_on_their_own(spark, home):
    put(f"{home}/sales", 0, [{"op": "+I", "id": 1, "qty": 5, "seq": 1}])
    put(f"{home}/returns", 0, [{"op": "+I", "id": 9, "qty": 1, "seq": 1}])

    def starter(domain):
        def fail(batch, batch_id):
            raise RuntimeError("broken domain")
        table = KeyedTable(spark, f"{home}/{domain}-table", ROW, ["id"], ["seq"], 2)
        write = fail if domain == "returns" else jobs.table_writer(table)
        return jobs.for_each_batch(change_stream(spark, f"{home}/{domain}"), write, domain, f"{home}/ck-{domain}",
                                   availableNow=True)
    queries = jobs.start_domains({"sales": starter, "returns": starter})
    queries["sales"].awaitTermination()
    with pytest.raises(Exception, match="broken domain"):
        queries["returns"].awaitTermination()
    assert KeyedTable(spark, f"{home}/sales-table", ROW, ["id"], ["seq"], 2).rows().count() == 1


def test_json_and_console_sinks(spark, home, capfd):
    put(f"{home}/in", 0, [{"op": "+I", "id": 1, "qty": 5, "seq": 1}])
    feed = change_stream(spark, f"{home}/in").withColumn("at", F.lit("2024-01-01 10:00:00.5").cast("timestamp"))
    sinks.json_stream(feed, f"{home}/json", f"{home}/ck1", "json_rows", availableNow=True).awaitTermination()
    back = feeds.json_rows(spark, f"{home}/json", feed.schema).first()
    assert (back.id, back.at) == (1, dt.datetime(2024, 1, 1, 10, 0, 0, 500000))
    sinks.console_stream(feed, "SALES-CDC", f"{home}/ck2", availableNow=True).awaitTermination()


def test_topic_as_a_stream(spark, home):
    write = sinks.topic_writer(home + "/topic", ["id"], ["id", "qty"], ["seq"], 2)
    write(spark.createDataFrame([("+I", 1, 5, 1), ("-D", 2, None, 2)], "op string, id long, qty int, seq long"), 0)
    stream = feeds.keyed_changes(feeds.topic_records(spark, home + "/topic", stream=True), columns("id:long"),
                                 columns("id:long qty:int"))
    out = run(stream, home, "topic_stream")
    assert sorted((r.op, r.id, r.qty) for r in out.collect()) == [("+U", 1, 5), ("-D", 2, None)]


def test_older_change_that_arrives_later_does_not_win(spark, home):
    """Across batches with equal record times, for values and for deletes; the same from a broker's records."""
    write = sinks.topic_writer(home + "/topic", ["id"], ["id", "qty"], ["seq"], 2)
    shape = "op string, id long, qty int, seq long"
    batches = [[("+I", 1, 5, 9), ("-D", 2, None, 9), ("+I", 3, 1, 1)], [("+U", 1, 4, 8), ("+U", 2, 7, 3), ("+U", 3, 2, 2)],
               [("+U", 3, 3, 2)]]
    for n, rows in enumerate(batches):
        write(spark.createDataFrame(rows, shape), n)
    same_time = feeds.topic_records(spark, home + "/topic").withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    broker = feeds.broker_records(same_time.withColumn("headers", F.array(
        F.struct(F.lit("other").alias("key"), F.lit(b"x").alias("value")),
        F.struct(F.lit(sinks.ORDER_HEADER).alias("key"), F.col("order").cast("binary").alias("value")))).drop("order"))
    for records in (same_time, broker):
        changes = feeds.keyed_changes(records, columns("id:long"), columns("id:long qty:int"), columns("seq:long"))
        kept = C.materialize(changes, ["id"], feeds.TOPIC_ORDER)
        # of two changes that tie, the one with the later offset counts
        assert sorted((r.id, r.qty) for r in kept.collect()) == [(1, 5), (3, 3)]
    no_header = feeds.broker_records(same_time.withColumn("headers", F.lit(None).cast("array<struct<key:string,value:binary>>")).drop("order"))
    assert {r.order for r in no_header.collect()} == {None}
    assert same_time.select(sinks.order_header()).first()[0][0].key == sinks.ORDER_HEADER


def test_jobs_clear_away_what_they_replaced(spark, home):
    keyed = KeyedTable(spark, f"{home}/table", ROW, ["id"], ["seq"], 2)
    write = jobs.table_writer(keyed, compact_every=3)
    for n in range(9):
        write(spark.createDataFrame([("+I", n, n, n)], "op string, id long, qty int, seq long"), n)
    assert keyed.rows().count() == 9
    assert len(files.names(spark, f"{home}/table/manifests")) == 3
    assert len(files.names(spark, f"{home}/table/batches")) <= 3


def test_restarted_stream_join_reads_its_open_state_only(spark):
    """The state is kept as files of each batch: a start that had to replay logs would replay all turns before."""
    def day(text, column="at"):
        return F.lit(text).cast("timestamp_ntz").alias(column)

    sold = [spark.range(n, n + 3).select(F.col("id").alias("ss_ticket_number"), F.lit(1).alias("ss_item_sk"), day(d))
            for n, d in ((0, "2024-01-01"), (3, "2024-03-01"), (6, "2024-06-01"))]
    back = [spark.range(n, n + 1).select(F.col("id").alias("sr_ticket_number"), F.lit(1).alias("sr_item_sk"), day(d))
            for n, d in ((0, "2024-01-05"), (4, "2024-03-09"), (6, "2024-06-09"))]
    settings = list(jobs.FEW_LARGE_BATCHES)
    set_before = [spark.conf.get(s, None) for s in settings]
    known = set(files.names(spark, work_dir(spark)))

    def joined(sales, returns):
        return returned_sales(X.with_event_time(sales, "at", "sold_at"), X.with_event_time(returns, "at", "returned_at")) \
            .select("ss_ticket_number", "returned_at")

    out = _in_two_folders(spark, "join-state", sold, back, joined, "min").collect()
    assert sorted((r[0], r[1] is not None) for r in out) == [
        (0, True), (1, False), (2, False), (3, False), (4, True), (5, False), (6, True)]
    assert [spark.conf.get(s, None) for s in settings] == set_before
    home, = (n for n in set(files.names(spark, work_dir(spark))) - known if n.startswith("join-state"))
    kept = [name for _, _, names in os.walk(f"{work_dir(spark)}/{home}/checkpoint/state") for name in names]
    assert any(n.endswith(".zip") for n in kept) and not any(n.endswith(".changelog") for n in kept)


LINE = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, " \
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"


def test_returned_sales_stream_keeps_what_is_open_as_files(spark, home):
    """No row of it goes through a state store, and of the closed rows nothing is kept."""
    def line(n, part, day, flag="N", quantity=3.0):
        at = None if day is None else dt.datetime.fromisoformat(day)
        return n, part, 1, 1, quantity, 10.0, 0.0, 0.0, flag, "O", at

    rows = [line(1, 1, "1996-05-01", "R"), line(1, 2, "1996-05-01"), line(2, 1, "1997-12-30", "R", 9.0), line(3, 1, "1998-02-01"),
            line(4, 1, "1999-03-01", "R", 40.0), line(5, 1, "2000-12-20"), line(5, 1, "2001-11-01", "R"), line(6, 1, None, "R"),
            line(7, 1, "2001-11-04"), line(None, 1, "1999-01-01", "R")]
    spark.createDataFrame(rows, LINE).write.parquet(f"{home}/lineitem.parquet")
    known = set(files.names(spark, work_dir(spark)))
    out = QUERIES["returned_sales_stream"](spark, home).collect()
    assert sorted((r.ss_ticket_number or 0, r.ss_item_sk, r.sold_at.year, r.returned_at and r.returned_at.isoformat()) for r in out) == [
        (0, 1, 1999, None), (1, 1, 1996, "1996-05-04T00:00:00"), (1, 2, 1996, None), (2, 1, 1997, "1998-01-08T00:00:00"),
        (3, 1, 1998, None), (4, 1, 1999, None), (5, 1, 2000, None), (5, 1, 2001, "2001-11-04T00:00:00")]
    kept, = (n for n in set(files.names(spark, work_dir(spark))) - known if n.startswith("returned-sales"))
    top = f"{work_dir(spark)}/{kept}"
    assert not os.path.exists(f"{top}/checkpoint/state")
    last, = os.listdir(f"{top}/pairs/open")
    still = spark.read.parquet(f"{top}/pairs/open/{last}/sales").collect()
    assert sorted((r.ss_ticket_number, r._matched) for r in still) == [(5, True), (6, False), (7, False)]
    assert spark.read.parquet(f"{top}/pairs/open/{last}/returns").count() == 1


SOLD = "ss_ticket_number long, ss_item_sk long, ss_line long, at timestamp_ntz"
BACK = "sr_ticket_number long, sr_item_sk long, sr_line long, at timestamp_ntz"


def odd_turns(spark):
    """Rows of three turns that overlap, so that some are late; keys and rows that repeat, and NULLs."""
    rnd = random.Random(7)

    def part(first, last, n, shape):
        def row():
            day = dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randint(first, last), milliseconds=rnd.choice([0, 0, 250]))
            return rnd.choice([None, *range(1, 40)]), rnd.choice([None, 1, 1, 2]), rnd.randint(1, 3), rnd.choice([None, *[day] * 20])
        found = [row() for _ in range(n)]
        # Spark leaves returns without a key out of the watermark, so the last row of a turn has one
        end = (50, 1, 1, dt.datetime(2024, 1, 1) + dt.timedelta(days=last, hours=1))
        return spark.createDataFrame([*found, *found[:20], end], shape)

    spans = [(0, 80), (60, 150), (120, 260)]
    return [part(*s, 250, SOLD) for s in spans], [part(*s, 180, BACK) for s in spans]


def paired(sold, back, root, policy="min"):
    return PairedStreams(X.with_event_time(sold, "at", "sold_at").drop("at"), X.with_event_time(back, "at", "returned_at").drop("at"),
                         root, policy, keep=PAIR)


PAIR = ["ss_ticket_number", "ss_item_sk", "ss_line", "sold_at", "sr_line", "returned_at"]


@pytest.mark.parametrize("policy", ["min", "max"])
def test_paired_streams_give_what_sparks_own_join_gives(spark, home, policy):
    sold, back = odd_turns(spark)

    def joined(sales, returns):
        return returned_sales(X.with_event_time(sales, "at", "sold_at"), X.with_event_time(returns, "at", "returned_at")).select(*PAIR)

    expected = rows(_in_two_folders(spark, "own-join", sold, back, joined, policy))
    for sides in _turns_in_two_folders(spark, home, sold, back):
        pairs = paired(*sides, f"{home}/pairs", policy)
        pairs.start("pairs", f"{home}/checkpoint", availableNow=True).awaitTermination()
    assert rows(pairs.rows()) == expected and len(expected) > 300


def test_returns_without_a_key_move_the_watermark_too(spark, home):
    """As in the query's SQL, where it trails the latest time of all rows."""
    sold = spark.createDataFrame([(1, 1, 1, dt.datetime(2024, 1, 1)), (2, 1, 1, dt.datetime(2024, 4, 1))], SOLD)
    back = spark.createDataFrame([(9, 1, 1, dt.datetime(2024, 1, 2)), (None, 1, 1, dt.datetime(2024, 4, 1))], BACK)
    for sides in _turns_in_two_folders(spark, home, [sold], [back]):
        pairs = paired(*sides, f"{home}/pairs")
        pairs.start("pairs", f"{home}/checkpoint", availableNow=True).awaitTermination()
    assert [r.ss_ticket_number for r in pairs.rows().collect()] == [1]


def test_a_batch_of_pairs_counts_once(spark, home, monkeypatch):
    """It fails after all its rows are written, is delivered again, and once more when it counts."""
    sold, back = odd_turns(spark)
    publish, failures, expected = files.publish_text, [], None
    for folder in ("plain", "failing"):
        top = f"{home}/{folder}"
        for turn, sides in enumerate(_turns_in_two_folders(spark, top, sold, back)):
            pairs = paired(*sides, f"{top}/pairs")
            if folder == "failing" and turn == 1:
                def broken(*args):
                    failures.append(pairs.rows().count())
                    raise RuntimeError("storage is down")
                monkeypatch.setattr(files, "publish_text", broken)
                before = pairs.rows().count()
                with pytest.raises(Exception, match="storage is down"):
                    pairs.start("pairs", f"{top}/checkpoint", availableNow=True).awaitTermination()
                assert failures == [before] and before > 0
                monkeypatch.setattr(files, "publish_text", publish)
            pairs.start("pairs", f"{top}/checkpoint", availableNow=True).awaitTermination()
        expected = expected or rows(pairs.rows())
        assert rows(pairs.rows()) == expected
    done = pairs._done()
    with pytest.raises(ValueError, match="another stream"):
        pairs.apply(None, done.batch + 1)
    from tidemark.sources.sinks import BatchNumber
    assert pairs.apply(None, BatchNumber(done.batch, done.stream)) is False
    with pytest.raises(ValueError, match="watermark"):
        PairedStreams(sides[0].withColumnRenamed("at", "sold_at"), sides[1].withColumnRenamed("at", "returned_at"), home)
