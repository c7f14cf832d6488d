"""Change-data operators on small rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import Observation, functions as F, types as T

from tidemark.functions import codecs
from tidemark.functions.codecs import decode_keyed, decode_rows, encode_keyed, key_partition
from tidemark.functions.temporal import change_time
from tidemark.operators import changes as C, shapes
from tidemark.schemas import RETURN_EVENT, STORE_RETURNS, STORE_SALES, columns, envelope_schema, warehouse_schema
from tidemark.sources import feeds, sinks

FEED = "op string, seq long, id long, qty int"
ROW = columns("id:long qty:int")


def feed(spark, *rows):
    return spark.createDataFrame(list(rows), FEED)


def state(df):
    return sorted((r.id, r.qty) for r in df.collect())


def test_update_overwrites_insert(spark):
    changes = feed(spark, ("+I", 1, 1, 5), ("-U", 2, 1, 5), ("+U", 3, 1, 10))
    assert state(C.materialize(changes, ["id"], ["seq"])) == [(1, 10)]


def test_delete_removes_and_may_be_followed_by_an_insert(spark):
    changes = feed(spark, ("+I", 1, 1, 5), ("-D", 2, 1, 5), ("+I", 1, 2, 7), ("-D", 2, 2, 7), ("+I", 3, 2, 8),
                   ("-D", 1, 3, 0))
    assert state(C.materialize(changes, ["id"], ["seq"])) == [(2, 8)]


def test_a_key_with_most_of_the_rows(spark):
    many = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("+U")).otherwise("+I").alias("op"), F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("id"), F.col("id").cast("int").alias("qty"))
    got = dict(state(C.materialize(many, ["id"], ["seq"])))
    want = {}
    for i in range(30_000):
        want[-1 if i % 3 == 0 else i % 500] = i
    assert got == want


def test_key_is_limited_before_the_shuffle(spark):
    plan = C.latest_per_key(feed(spark, ("+I", 1, 1, 5)), ["id"], ["seq"])._jdf.queryExecution().toString()
    before_shuffle = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_apply_changes_equals_a_dictionary(spark):
    table = spark.createDataFrame([(i, i) for i in range(50)], "id long, qty int")
    batch = feed(spark, ("+U", 1, 3, 33), ("-D", 2, 4, 0), ("+I", 1, 99, 9), ("+U", 5, 3, 34), ("-D", 1, 777, 0))
    want = {i: i for i in range(50)}
    want.update({3: 34, 99: 9})
    del want[4]
    assert state(C.apply_changes(table, batch, ["id"], ["seq"])) == sorted(want.items())


def test_snapshot_comes_before_changes(spark):
    snapshot = spark.createDataFrame([(1, 5), (2, 6)], "id long, qty int")
    changes = feed(spark, ("+U", 1, 1, 50), ("-D", 1, 2, 6), ("+I", 2, 3, 7))
    assert state(C.materialize(C.snapshot_then_changes(snapshot, changes), ["id"], ["seq"])) == [(1, 50), (3, 7)]


def envelope(op, seq, before=None, after=None, **extra):
    return json.dumps({"op": op, "seq": seq, "op_ts": "2025-06-27T07:53:21Z", "db_name": "business_db",
                       "table_name": "store_sales", "before": before, "after": after, **extra})


def test_envelopes_split_into_images(spark):
    texts = [envelope("INSERT", 1, after={"id": 1, "qty": 5}),
             envelope("u", 2, {"id": 1, "qty": 5}, {"id": 1, "qty": 10}),
             envelope("DELETE", 3, {"id": 1, "qty": 10}),
             envelope("r", 0, after={"id": 2})]
    records = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = feeds.change_feed(records, ROW).collect()
    assert sorted((r.seq, r.op, r.id, r.qty) for r in rows if r.qty) == [
        (1, "+I", 1, 5), (2, "+U", 1, 10), (2, "-U", 1, 5), (3, "-D", 1, 10)]
    assert [(r.id, r.db_name, r.table_name) for r in rows if not r.qty] == [(2, "business_db", "store_sales")]
    assert rows[0].op_ts == dt.datetime(2025, 6, 27, 7, 53, 21)
    # What does not parse, or is of an unknown kind, is never lost in silence.
    for bad in ("{broken", envelope("TRUNCATE", 4)):
        with pytest.raises(Exception, match="MALFORMED|unknown kind of change"):
            feeds.change_feed(records.union(spark.createDataFrame([(bad,)], "value string")), ROW).collect()
    broken = records.union(spark.createDataFrame([("{broken",)], "value string"))
    assert feeds.change_feed(broken, ROW, required=False).count() == len(rows)
    assert codecs.unreadable(broken, {"value": envelope_schema(ROW)}).first() == (5, 1)


def test_kind_records_keep_both_images(spark):
    texts = ['{"op_type":"+I","id":1,"qty":5}', '{"op_type":"-U","id":1,"qty":5}', '{"op_type":"+U","id":1,"qty":6}',
             '{"op_type":"+I","id":2,"qty":7}', '{"op_type":"-D","id":2,"qty":7}']
    changes = feeds.kind_feed(spark.createDataFrame([(t,) for t in texts], "value string"), ROW)
    assert sorted(r.op for r in changes.collect()) == ["+I", "+I", "+U", "-D", "-U"]
    assert C.running_count(changes).first().row_count == 1
    with pytest.raises(Exception, match="unknown kind of change"):
        feeds.kind_feed(spark.createDataFrame([('{"op_type":"?","id":1}',)], "value string"), ROW).collect()


def test_corrupt_values_are_no_upserts(spark):
    records = spark.createDataFrame([('{"id":1}', '{"qty":5}'), ('{"id":1}', "{broken"), ("{bad", '{"qty":1}'), ('{"id":2}', None)],
                                    "key string, value string")
    key = T.StructType([f for f in ROW.fields if f.name == "id"])
    back = codecs.decode_keyed(records, key, ROW).collect()
    assert sorted((r.op, r.id, r.qty) for r in back if r.op == "+U") == [("+U", 1, 5)]
    assert [(r.id, r.qty) for r in back if r.op == "-D"] == [(2, None)]
    assert codecs.unreadable(records, {"key": key, "value": ROW}).first() == (4, 1, 1)


def test_dropped_rows_are_counted(spark):
    counts = Observation()
    rows = C.drop_null_rows(spark.createDataFrame([(1, None), (2, 3), (None, 4)], "id long, qty int"), ["id", "qty"], counts)
    assert rows.count() == 1 and counts.get == {"rows": 3, "dropped": 2}


def test_json_keeps_microseconds(spark, home):
    at = dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    rows = spark.createDataFrame([(1, at)], "id long, at timestamp")
    sinks.write_json_rows(rows, f"{home}/json")
    assert feeds.json_rows(spark, f"{home}/json", rows.schema).first().at == at
    text = rows.select(codecs.encode_row(["at"]).alias("value"))
    assert codecs.decode_rows(text, "value", rows.schema).first().at == at


def test_full_width_sources_decode(spark):
    sale = {"id": 1, "ss_item_sk": 1001, "ss_ticket_number": 1000001, "ss_sales_price": 79.99,
            "created_at": "2024-01-01T10:00:00", "updated_at": "2024-01-01T10:00:00.250Z"}
    row = feeds.change_feed(spark.createDataFrame([(envelope("+I", 1, after=sale),)], "value string"), STORE_SALES).first()
    assert len(STORE_SALES) == 26 and len(STORE_RETURNS) == 23
    assert (row.id, str(row.ss_sales_price), row.ss_net_paid) == (1, "79.99", None)
    assert row.updated_at == dt.datetime(2024, 1, 1, 10, 0, 0, 250000)
    target = shapes.to_warehouse(spark.createDataFrame([], STORE_SALES)).schema
    assert target.names == warehouse_schema(STORE_SALES).names and len(target) == 25


def test_running_count_and_mix(spark):
    changes = feed(spark, ("+I", 1, 1, 5), ("+I", 1, 2, 5), ("-U", 2, 1, 5), ("+U", 2, 1, 6), ("-D", 3, 2, 5))
    assert C.running_count(changes).first().row_count == 1
    assert {r.op: r.changes for r in C.op_mix(changes).collect()} == {"+I": 2, "-U": 1, "+U": 1, "-D": 1}
    assert C.running_count(changes.filter("false")).first().row_count == 0


def test_diff_leads_from_old_to_new(spark):
    old = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "id long, qty int")
    new = spark.createDataFrame([(1, 6), (2, None), (4, 8)], "id long, qty int")
    diff = {r.id: r.op for r in C.diff_changes(old, new, ["id"]).collect()}
    assert diff == {1: "+U", 3: "-D", 4: "+I"}


def test_append_only_target_refuses_updates(spark, home):
    changes = feed(spark, ("+I", 1, 1, 5), ("+U", 2, 1, 6))
    with pytest.raises(Exception, match="append-only target got a change of kind \\+U"):
        sinks.append_writer(f"{home}/refuse")(changes, 0)
    # also when only a count is asked for, which reads no column
    with pytest.raises(Exception, match="append-only target"):
        C.inserts_only(changes).count()
    sinks.append_writer(f"{home}/drop", others="drop")(changes, 0)
    assert spark.read.parquet(f"{home}/drop/batch=0").count() == 1
    with pytest.raises(ValueError):
        C.inserts_only(changes, "maybe")


def test_tombstones_round_trip(spark):
    changes = feed(spark, ("+I", 1, 1, 5), ("-U", 2, 1, 5), ("+U", 3, 1, 10), ("-D", 4, 2, 0))
    records = encode_keyed(changes, ["id"], ["id", "qty"])
    got = [(r.key, r.value) for r in records.collect()]
    assert got == [('{"id":1}', '{"id":1,"qty":5}'), ('{"id":1}', '{"id":1,"qty":10}'), ('{"id":2}', None)]
    back = decode_keyed(records, columns("id:long"), ROW).collect()
    assert [(r.op, r.id, r.qty) for r in back] == [("+U", 1, 5), ("+U", 1, 10), ("-D", 2, None)]


def test_same_key_same_partition(spark):
    keyed = spark.range(1000).select((F.col("id") % 50).alias("id")).withColumn("p", key_partition(["id"], 7))
    per_key = keyed.groupBy("id").agg(F.count_distinct("p").alias("n")).collect()
    assert len(per_key) == 50 and all(r.n == 1 for r in per_key)
    assert 0 <= keyed.agg(F.min("p")).first()[0] and keyed.agg(F.max("p")).first()[0] < 7


def test_topic_files_keep_a_key_together(spark, home):
    many = spark.range(500).select(F.lit("+U").alias("op"), F.col("id").alias("seq"),
                                   (F.col("id") % 40).alias("id"), F.lit(1).alias("qty"))
    sinks.topic_writer(home, ["id"], ["id", "qty"], ["seq"], 4)(many, 0)
    sinks.topic_writer(home, ["id"], ["id", "qty"], ["seq"], 4)(many, 0)  # replay
    files = spark.read.parquet(f"{home}/batch=0").withColumn("file", F.input_file_name())
    assert files.count() == 40
    assert files.groupBy("partition").agg(F.count_distinct("file").alias("n")).filter("n > 1").count() == 0


def test_json_decode_is_lenient(spark):
    texts = ['{"id": 1, "sr_return_amt": 79.99, "extra": 1}', "not json", '{"id": "x"}', None, '{"id": 2}']
    rows = decode_rows(spark.createDataFrame([(t,) for t in texts], "value string"), "value", RETURN_EVENT).collect()
    assert [(r.id, r.sr_store_sk) for r in rows] == [(1, None), (2, None)]
    with pytest.raises(Exception):
        decode_rows(spark.createDataFrame([("not json",)], "value string"), "value", RETURN_EVENT, required=True).collect()


def test_event_time_of_snapshot_rows(spark):
    at = lambda text: F.lit(text).cast("timestamp")
    row = spark.range(1).select(
        change_time(at("1970-01-01"), at("2025-01-02"), at("2030-01-01")).alias("a"),
        change_time(at("2025-01-01"), at("2025-01-02"), at("2030-01-01")).alias("b"),
        change_time(at(None), at(None), at("2030-01-01")).alias("c")).first()
    assert [v.year for v in row] == [2025, 2025, 2030] and row.a.day == 2 and row.b.day == 1


def test_not_null_rows(spark):
    rows = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert [r.a for r in C.drop_null_rows(rows, ["a"]).collect()] == [1, 3]
