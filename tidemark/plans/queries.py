"""One query per operator, over the whole test tables. ``oracle.py`` has the matching SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import amounts
from ..functions.codecs import JSON_TIMES, decode_rows, encode_row, unreadable
from ..functions.temporal import (compact_date_key, date_of_compact_key, date_of_julian_key, hours_between,
                                  julian_date_key, julian_key_of, second_of_day, to_zone)
from ..operators import changes as C, quality as Q, ranking as R, shapes, star, windows as X
from ..schemas import STORE_RETURNS, STORE_SALES, columns
from ..session import DEFAULTS, fresh_dir
from ..sources import feeds, sinks
from ..streaming import jobs
from ..streaming.keyed import KeyedTable
from ..streaming.view import MaintainedView, apply_to_both
from . import tables as D

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function name, with the session settings it relies on."""
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for name, value in DEFAULTS.items():
            if name.startswith("spark.sql."):
                spark.conf.set(name, value)
        return D.presentable(build(spark, sf_dir))
    QUERIES[build.__name__] = run
    return run


def _sales(spark, sf_dir):
    return X.with_event_time(D.sales_events(D.table(spark, sf_dir, "events")))


def _returns(spark, sf_dir):
    return X.with_event_time(D.return_events(D.table(spark, sf_dir, "events")))


def lines(spark, sf_dir):
    return D.table(spark, sf_dir, "lineitem")


def dims(spark, sf_dir):
    return D.date_dim(D.table(spark, sf_dir, "orders")), D.store_dim(spark, sf_dir)


# -- event-time windows --------------------------------------------------------------------

@query
def sales_metrics_tumbling(spark, sf_dir):
    return X.sales_metrics(_sales(spark, sf_dir), size="1 day")


@query
def sales_metrics_by_minute(spark, sf_dir):
    return X.sales_metrics(_sales(spark, sf_dir))


@query
def return_metrics_tumbling(spark, sf_dir):
    return X.return_metrics(_returns(spark, sf_dir), size="1 day")


@query
def return_alerts(spark, sf_dir):
    return X.return_alerts(_returns(spark, sf_dir), size="1 day")


@query
def item_trends_hopping(spark, sf_dir):
    return X.item_trends(_sales(spark, sf_dir), size="1 day", slide="6 hours")


@query
def top_item_per_window(spark, sf_dir):
    return X.top_items(_sales(spark, sf_dir), size="1 day")


@query
def true_return_rate(spark, sf_dir):
    return X.true_return_rate(_sales(spark, sf_dir), _returns(spark, sf_dir), size="1 day")


def _stream_to_table(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there now and read back what it wrote."""
    spark = df.sparkSession
    home = fresh_dir(spark, name)
    jobs.append_to_parquet(df, f"{home}/out", name, f"{home}/checkpoint", availableNow=True).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{home}/out")


@query
def sales_metrics_stream(spark, sf_dir):
    sales = X.with_event_time(D.sales_events(D.table_stream(spark, sf_dir, "events")))
    return _stream_to_table(X.sales_metrics(sales, size="1 day"), "sales_metrics_stream")


@query
def return_alerts_stream(spark, sf_dir):
    returns = X.with_event_time(D.return_events(D.table_stream(spark, sf_dir, "events")))
    return _stream_to_table(X.return_alerts(returns, size="1 day"), "return_alerts_stream")


@query
def item_trends_stream(spark, sf_dir):
    sales = X.with_event_time(D.sales_events(D.table_stream(spark, sf_dir, "events")))
    return _stream_to_table(X.item_trends(sales, size="1 day", slide="6 hours"), "item_trends_stream")


def in_turns(parts: list[DataFrame], folder: str, run: Callable[[int], None]) -> None:
    """Parts arrive in a folder one after another; after each, the streams over it go on."""
    for turn, part in enumerate(parts):
        part.write.mode("append").parquet(folder)
        run(turn)


def events_in_turns(spark, sf_dir, name: str, parts: list, streams: dict) -> dict[str, DataFrame]:
    """Operators as streams over parts of the events. Each stops after a part and starts again
    from its checkpoint for the next one; what they wrote is read back."""
    home, events = fresh_dir(spark, name), D.table(spark, sf_dir, "events")
    shapes_of: dict[str, T.StructType] = {}

    def starter(domain: str):
        result = streams[domain](feeds.file_stream(spark, f"{home}/in", events.schema))
        shapes_of[domain] = result.schema
        return jobs.append_to_parquet(result, f"{home}/out-{domain}", f"{name}-{domain}", f"{home}/checkpoint-{domain}",
                                      availableNow=True)

    def run(turn: int) -> None:
        started = jobs.start_domains({domain: starter for domain in streams})
        for one in started.values():
            one.awaitTermination()

    in_turns([events.filter(part) for part in parts], f"{home}/in", run)
    return {d: spark.read.schema(shapes_of[d]).parquet(f"{home}/out-{d}") for d in streams}


def decades(time: str = "ts"):
    """The events' days in three parts, the first also holding those without a time."""
    day = F.coalesce(F.dayofmonth(time), F.lit(0))
    return [day <= 10, (day > 10) & (day <= 20), day > 20]


def _sales_by_day(events: DataFrame) -> DataFrame:
    return X.sales_metrics(X.with_event_time(D.sales_events(events)), size="1 day")


@query
def restart_stream(spark, sf_dir):
    """Sales metrics by a stream that is stopped twice: open windows go on from the checkpoint."""
    return events_in_turns(spark, sf_dir, "restart", decades(), {"sales": _sales_by_day})["sales"]


@query
def late_rows_stream(spark, sf_dir):
    """Store 3 reports when all others have: rows of windows that are closed by then do not count."""
    late = F.coalesce(F.col("user_id") % 10 == 3, F.lit(False))
    return events_in_turns(spark, sf_dir, "late-rows", [~late, late], {"sales": _sales_by_day})["sales"]


@query
def two_domains_stream(spark, sf_dir):
    """Sales and returns as jobs of their own at the same time, each with its own checkpoint."""
    def returns(events):
        return X.return_metrics(X.with_event_time(D.return_events(events)), size="1 day")

    out = events_in_turns(spark, sf_dir, "domains", decades(), {"sales": _sales_by_day, "returns": returns})
    keys = ["window_start", "store_sk"]
    return out["sales"].select(F.lit("sales").alias("domain"), *keys, F.col("total_sales").alias("events"),
                               F.col("total_revenue").alias("amount")).unionByName(
        out["returns"].select(F.lit("returns").alias("domain"), *keys, F.col("total_returns").alias("events"),
                              F.col("total_return_amount").alias("amount")))


@query
def running_count_stream(spark, sf_dir):
    """The size of the table after each part of its feed, by a stream that keeps one count."""
    home = fresh_dir(spark, "running-count")

    def run(turn: int) -> None:
        def keep(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{home}/counts/turn={turn}")
        feed = D.line_changes(feeds.file_stream(spark, f"{home}/in", D.SCHEMAS["lineitem"]))
        jobs.for_each_batch(C.running_count(feed), keep, "running_count_stream", f"{home}/checkpoint",
                            output_mode="complete", availableNow=True).awaitTermination()

    in_turns(line_parts(spark, sf_dir), f"{home}/in", run)
    return spark.read.schema("row_count bigint, turn int").parquet(f"{home}/counts")


@query
def processing_times(spark, sf_dir):
    """A stream's rows with the time at which each was taken in, next to the time of the event."""
    feed = feeds.with_processing_time(D.table_stream(spark, sf_dir, "events").select("event_id", "ts"))
    stored = _stream_to_table(feed, "processing_times")
    return stored.agg(F.count("proc_time").alias("stamped_rows"), F.count_if(
        F.col("proc_time").cast("timestamp_ntz") > F.col("ts")).alias("after_event"))


@query
def sales_per_local_day(spark, sf_dir):
    """Daily windows of another zone: event times are local ones before they are put into windows."""
    sales = D.sales_events(D.table(spark, sf_dir, "events"))
    local = sales.withColumn("created_at", to_zone(F.col("created_at"), "UTC", "Asia/Shanghai"))
    return X.sales_metrics(X.with_event_time(local), size="1 day")


@query
def projection_stream(spark, sf_dir):
    """A stateless stream: the sales monitor over the change feed."""
    feed = D.table_stream(spark, sf_dir, "lineitem").select(
        D.line_op().alias("op_type"), F.col("l_shipdate").alias("op_time"), *D.LINE_KEY,
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("ext_sales_price"))
    return _stream_to_table(feed, "projection_stream")


def _json_stream(events: DataFrame, name: str, operator) -> DataFrame:
    """Events as JSON records in a folder, streamed from there through an operator to JSON rows."""
    spark = events.sparkSession
    home = fresh_dir(spark, name)
    instants = events.withColumn("created_at", F.col("created_at").cast("timestamp"))
    instants.select(encode_row(instants.columns).alias("value")).write.text(f"{home}/in")
    records = feeds.file_stream(spark, f"{home}/in", columns("value:string"), "text")
    result = operator(feeds.event_stream(records, instants.schema))
    sinks.json_stream(result, f"{home}/out", f"{home}/checkpoint", name, availableNow=True).awaitTermination()
    return feeds.json_rows(spark, f"{home}/out", result.schema)


@query
def json_sales_stream(spark, sf_dir):
    sales = D.sales_events(D.table(spark, sf_dir, "events"))
    return _json_stream(sales, "json_sales_stream", lambda df: X.sales_metrics(df, size="1 day"))


@query
def json_returns_stream(spark, sf_dir):
    returns = D.return_events(D.table(spark, sf_dir, "events"))
    return _json_stream(returns, "json_returns_stream", lambda df: X.return_metrics(df, size="1 day"))


# -- JSON feeds ----------------------------------------------------------------------------

@query
def lenient_json_decode(spark, sf_dir):
    """Event properties, with those of error events cut off so that they do not parse."""
    text = F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    events = D.table(spark, sf_dir, "events").select("event_id", text.alias("value"))
    return decode_rows(events, "value", columns("k:int missing:string"), keep=["event_id"]) \
        .select("event_id", "k", F.col("missing").isNull().alias("missing_is_null"))


@query
def json_event_feed(spark, sf_dir):
    """Sales as JSON lines in a folder, read back by declared schema, summed per store."""
    sales = D.sales_events(D.table(spark, sf_dir, "events")).withColumn("created_at", F.col("created_at").cast("timestamp"))
    path = fresh_dir(spark, "json-feed")
    sinks.write_json_rows(sales, path)
    return feeds.json_rows(spark, path, sales.schema).groupBy("store_sk").agg(
        F.count("*").alias("rows_read"), F.sum("ext_sales_price").alias("revenue"),
        F.min("created_at").cast("timestamp").alias("first_sale"))


def _envelopes(lineitem: DataFrame) -> DataFrame:
    """Change records as JSON text. An update's before-image has one piece less."""
    row = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    kind = F.col("op")
    before = F.struct("l_orderkey", "l_linenumber", (F.col("l_quantity") - 1).alias("l_quantity"), "l_extendedprice")
    return lineitem.withColumn("op", D.line_op()).select(F.to_json(F.struct(
        F.when(kind == "+I", "INSERT").when(kind == "+U", "UPDATE").otherwise("DELETE").alias("op"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("seq"),
        F.col("l_shipdate").cast("timestamp").alias("op_ts"),
        F.lit("business").alias("db_name"), F.lit("lineitem").alias("table_name"),
        F.when(kind == "+U", before).when(kind == "-D", F.struct(*row)).alias("before"),
        F.when(kind != "-D", F.struct(*row)).alias("after"),
    )).alias("value"))


_ENVELOPE_ROW = columns("l_orderkey:long l_linenumber:int l_quantity:double l_extendedprice:double")


@query
def envelope_changes(spark, sf_dir):
    """Envelopes split into one change per image, with their metadata columns."""
    return feeds.change_feed(_envelopes(lines(spark, sf_dir)), _ENVELOPE_ROW)


def _change_scan(changes: DataFrame, table_name: str, row: T.StructType) -> DataFrame:
    """Write changes as JSON envelopes to a folder, then scan that as a feed of full rows.

    The envelopes repeat every field name, so they are kept compressed, in files that several tasks can
    read: a plain text of them takes six times the space.
    """
    spark, path = changes.sparkSession, fresh_dir(changes.sparkSession, f"{table_name}-feed")
    D.as_envelopes(changes, table_name).write.option("compression", "zstd").parquet(path)
    return feeds.change_feed(spark.read.schema("value string").parquet(path), row)


@query
def sales_change_scan(spark, sf_dir):
    """Full-width change feed of sales, with its metadata columns."""
    return _change_scan(D.wide_sales(lines(spark, sf_dir)), "store_sales", STORE_SALES)


@query
def returns_change_scan(spark, sf_dir):
    """Full-width change feed of returns."""
    return _change_scan(D.wide_returns(lines(spark, sf_dir)), "store_returns", STORE_RETURNS)


@query
def envelope_signed_sums(spark, sf_dir):
    """What the images add to and take from each table column."""
    images = feeds.change_feed(_envelopes(lines(spark, sf_dir)), _ENVELOPE_ROW)
    return images.groupBy("op").agg(
        F.sum(C.sign()).alias("row_balance"), F.sum(F.col("l_quantity") * C.sign()).alias("quantity_balance"))


# -- changes by key ------------------------------------------------------------------------

@query
def cdc_latest_state(spark, sf_dir):
    return C.materialize(D.line_changes(lines(spark, sf_dir)), D.LINE_KEY, D.LINE_ORDER)


def _other_key_state(spark, sf_dir, keys):
    order = [c for c in [*D.LINE_ORDER, *D.LINE_KEY] if c not in keys]
    return C.materialize(D.line_changes(lines(spark, sf_dir)), keys, order).select("op", *D.LINE_ROW.names)


@query
def ticket_key_state(spark, sf_dir):
    """The feed keyed by ticket alone."""
    return _other_key_state(spark, sf_dir, ["l_orderkey"])


@query
def composite_key_state(spark, sf_dir):
    """The feed keyed by date, store and item."""
    return _other_key_state(spark, sf_dir, ["l_shipdate", "l_suppkey", "l_partkey"])


def keyed_table(spark, home, buckets=8):
    return KeyedTable(spark, home, D.LINE_ROW, D.LINE_KEY, D.LINE_ORDER, buckets)


@query
def cdc_upsert_stream(spark, sf_dir):
    """The feed as a stream into a keyed table.

    The table takes changes in any order, so a long feed may come in batches of bounded size.
    """
    home = fresh_dir(spark, "cdc-upsert")
    keyed = keyed_table(spark, f"{home}/table")
    feed = D.line_changes(D.table_stream(spark, sf_dir, "lineitem", maxBytesPerTrigger=str(256 * 2**30)))
    jobs.for_each_batch(feed, jobs.table_writer(keyed), "cdc_upsert_stream", f"{home}/checkpoint",
                        availableNow=True).awaitTermination()
    return keyed.rows()


def _line_part():
    """Which of four parts of the feed a line is in, by its year; lines without a date come first."""
    return F.least(F.greatest(F.coalesce(F.year("l_shipdate"), F.lit(0)) - 1997, F.lit(0)), F.lit(3))


def line_parts(spark, sf_dir):
    return [lines(spark, sf_dir).filter(_line_part() == n) for n in range(4)]


def _shuffled_parts(spark, sf_dir):
    """The same parts as they may arrive on a bad day: newer ones before older ones."""
    parts = line_parts(spark, sf_dir)
    return [parts[n] for n in (2, 0, 3, 1)]


def _halves(spark, sf_dir):
    """The feed before and from a day on; lines without a date come first."""
    feed, cut = D.line_changes(lines(spark, sf_dir)), F.lit("1998-01-01").cast("timestamp_ntz")
    late = F.coalesce(F.col("l_shipdate") >= cut, F.lit(False))
    return feed.filter(~late), feed.filter(late)


@query
def snapshot_then_changes(spark, sf_dir):
    """The table as of a day, then the changes since, as one ordered feed."""
    before, after = _halves(spark, sf_dir)
    snapshot = C.materialize(before, D.LINE_KEY, D.LINE_ORDER).drop("op")
    since = after.withColumn("seq", F.unix_seconds(F.col("l_shipdate").cast("timestamp")))
    feed = C.snapshot_then_changes(snapshot, since)
    return C.materialize(feed, D.LINE_KEY, ["seq", *D.LINE_ORDER]).drop("seq", "op")


@query
def row_operations(spark, sf_dir):
    """Insert, update and delete by key on a table, in one step."""
    before, after = _halves(spark, sf_dir)
    table = C.materialize(before, D.LINE_KEY, D.LINE_ORDER).drop("op")
    return C.apply_changes(table, after, D.LINE_KEY, D.LINE_ORDER)


@query
def atomic_batches(spark, sf_dir):
    """A batch that failed half-way, its repetition, and one delivered twice."""
    before, after = _halves(spark, sf_dir)
    keyed = keyed_table(spark, fresh_dir(spark, "atomic"))
    keyed.apply(before, 0)
    keyed.apply(before, 0)
    keyed.stage(after, 1)  # written, never committed
    keyed.apply(after, 1)
    keyed.table.compact()
    keyed.apply(before, 1)
    return keyed.rows()


@query
def late_changes(spark, sf_dir):
    """The newer half of the feed first: older changes that come later must not win."""
    before, after = _halves(spark, sf_dir)
    keyed = keyed_table(spark, fresh_dir(spark, "late"))
    keyed.apply(after, 0)
    keyed.table.compact()
    keyed.apply(before, 1)
    return keyed.rows()


@query
def cdc_op_mix(spark, sf_dir):
    return C.op_mix(D.line_changes(lines(spark, sf_dir)))


def versions(spark, sf_dir):
    before, after = _halves(spark, sf_dir)
    old = C.materialize(before, D.LINE_KEY, D.LINE_ORDER).drop("op")
    new = C.materialize(before.unionByName(after), D.LINE_KEY, D.LINE_ORDER).drop("op")
    return old.select(*D.LINE_ROW.names), new.select(*D.LINE_ROW.names)


@query
def cdc_signed_count(spark, sf_dir):
    """Size of a table from its change images alone: those of the snapshot and those since."""
    old, new = versions(spark, sf_dir)
    since = C.split_images(C.diff_changes(old, new, D.LINE_KEY), [])
    return C.running_count(old.withColumn("op", F.lit(C.INSERT)).unionByName(since))


@query
def version_changes(spark, sf_dir):
    """Inserts, updates and deletes that lead from one version of a table to the next."""
    old, new = versions(spark, sf_dir)
    return C.op_mix(C.diff_changes(old, new, D.LINE_KEY))


@query
def keyed_topic(spark, sf_dir):
    """Upserts and tombstones as key and value text, written to a topic and dumped from it."""
    priced = lines(spark, sf_dir).withColumns({"op": D.line_op(), "price": F.col("l_extendedprice").cast("decimal(12,2)")})
    root = fresh_dir(spark, "topic")
    sinks.topic_writer(root, D.LINE_KEY, [*D.LINE_KEY, "l_partkey", "price", "l_shipdate"], D.LINE_ORDER)(priced, 0)
    return feeds.topic_records(spark, root).select(
        "key", F.coalesce("value", F.lit("tombstone")).alias("value"),
        F.col("timestamp").isNotNull().alias("has_timestamp"))


@query
def topic_compaction(spark, sf_dir):
    """Four batches on a keyed topic, older ones after newer ones, and all with the same time.
    The last value per key, by the order that the records carry, is the table."""
    root = fresh_dir(spark, "compaction")
    values = [*D.LINE_KEY, "l_partkey", "l_quantity", "l_shipdate"]
    write = sinks.topic_writer(root, D.LINE_KEY, values, D.LINE_ORDER)
    for batch_id, batch in enumerate(_shuffled_parts(spark, sf_dir)):
        write(D.line_changes(batch), batch_id)
    records = feeds.topic_records(spark, root).withColumn("timestamp", _loaded())
    return _table_of(records).select(*values)


def _table_of(records):
    """The lines that the records of a keyed topic add up to."""
    order = T.StructType([D.LINE_ROW[name] for name in D.LINE_ORDER])
    changes = feeds.keyed_changes(records, T.StructType(D.LINE_ROW.fields[:2]), D.LINE_ROW, order)
    return C.materialize(changes, D.LINE_KEY, feeds.TOPIC_ORDER).drop(*feeds.TOPIC_ORDER)


@query
def row_kind_changes(spark, sf_dir):
    """Records of one image each, all four kinds: what they say about the table they lead to."""
    old, new = versions(spark, sf_dir)
    images = old.withColumn("op", F.lit(C.INSERT)).unionByName(
        C.split_images(C.diff_changes(old, new, D.LINE_KEY), []))
    fields = [F.col("op").alias("op_type"), *D.LINE_ROW.names]
    records = images.select(F.to_json(F.struct(*fields), JSON_TIMES).alias("value"))
    changes = feeds.kind_feed(records, D.LINE_ROW)
    return changes.agg(
        F.sum(C.sign()).alias("row_count"), F.sum(F.col("l_partkey") * C.sign()).alias("part_keys"),
        F.count_if(F.col("op") == C.BEFORE).alias("before_images"), F.count_if(F.col("op") == C.AFTER).alias("after_images"))


def _topic_of_lines(spark, sf_dir, values):
    root = fresh_dir(spark, "topic")
    changes = lines(spark, sf_dir).withColumn("op", D.line_op())
    sinks.topic_writer(root, D.LINE_KEY, values, D.LINE_ORDER)(changes, 0)
    return feeds.topic_records(spark, root)


@query
def keyed_topic_with_bad_records(spark, sf_dir):
    """Each record followed by one with a broken value and one with a broken key; the table stays."""
    good = _topic_of_lines(spark, sf_dir, D.LINE_ROW.names)
    later = good.withColumn("timestamp", F.col("timestamp") + F.expr("interval 1 hour"))
    records = good.unionByName(later.withColumn("value", F.lit('{"l_partkey": '))) \
        .unionByName(later.withColumn("key", F.lit("{broken")))
    key = T.StructType(D.LINE_ROW.fields[:2])
    kept = C.materialize(feeds.keyed_changes(records, key, D.LINE_ROW), D.LINE_KEY, ["timestamp"])
    tables = kept.agg(F.count("*").alias("rows_kept"), F.sum("l_partkey").alias("part_keys"))
    skipped = unreadable(records, {"key": key, "value": D.LINE_ROW})
    return tables.unpivot([], ["rows_kept", "part_keys"], "measure", "value").unionByName(
        skipped.unpivot([], ["bad_key", "bad_value"], "measure", "value"))


@query
def second_checkpoint(spark, sf_dir):
    """Two streams that both count from 0, one after the other, into the same table: nothing is lost."""
    before, after = _halves(spark, sf_dir)
    keyed = keyed_table(spark, fresh_dir(spark, "second"))
    for stream, part in (("first", before), ("second", after)):
        keyed.apply(part, sinks.BatchNumber(0, stream))
        keyed.apply(part, sinks.BatchNumber(0, stream))  # delivered again: no effect
    return keyed.rows()


@query
def view_rebuild_in_between(spark, sf_dir):
    """A rebuild between two batches of the feed; the view goes on with the second."""
    home = fresh_dir(spark, "rebuild-between")
    keyed, view = keyed_table(spark, f"{home}/table"), fact_view(spark, f"{home}/view")
    for batch_id, batch in enumerate(_halves(spark, sf_dir)):
        apply_to_both(batch, batch_id, keyed, view)
        if batch_id == 0:
            view.rebuild(keyed.rows(), keyed)
    return view.rows(*dims(spark, sf_dir))


@query
def peek_check(spark, sf_dir):
    """How many rows a peek of five gives, and how many of them are in the feed."""
    feed = D.line_changes(lines(spark, sf_dir))
    names = feed.columns
    found = feed.limit(5).join(feed, names, "left_semi")
    return found.agg(F.count("*").alias("rows_found"))


@query
def append_inserts(spark, sf_dir):
    """An insert-only target that is told to leave other changes out."""
    path = fresh_dir(spark, "append")
    feed = D.line_changes(lines(spark, sf_dir))
    sinks.append_writer(path, others="drop")(feed, 0)
    return spark.read.schema(D.LINE_ROW).parquet(f"{path}/batch=0")


@query
def append_refused(spark, sf_dir):
    """The same target without being told: it refuses the feed, and nothing of it is there."""
    path, feed = fresh_dir(spark, "refused"), D.line_changes(lines(spark, sf_dir))
    try:
        sinks.append_writer(path)(feed, 0)
        refused = False
    except PySparkException as error:
        refused = "append-only target" in str(error)
    written = feeds.written_batches(spark, path, feed.drop("op").schema)
    return C.op_mix(feed).select("op", "changes", F.lit(refused).alias("refused"),
                                 F.lit(written.count()).cast("bigint").alias("rows_written"))


@query
def fanout_reconcile(spark, sf_dir):
    """One stream to a keyed topic and to a keyed table, in four batches of which some hold older
    changes than those before; what the two hold must agree."""
    home = fresh_dir(spark, "fanout")
    keyed = keyed_table(spark, f"{home}/table")
    values = D.LINE_ROW.names
    targets = {"topic": sinks.topic_writer(f"{home}/topic", D.LINE_KEY, values, D.LINE_ORDER),
               "table": jobs.table_writer(keyed)}

    def run(turn: int) -> None:
        feed = D.line_changes(feeds.file_stream(spark, f"{home}/in", D.SCHEMAS["lineitem"]))
        jobs.fan_out(feed, targets, "fanout_reconcile", f"{home}/checkpoint",
                     prepare=lambda batch: C.latest_per_key(batch, D.LINE_KEY, D.LINE_ORDER),
                     availableNow=True).awaitTermination()

    in_turns(_shuffled_parts(spark, sf_dir), f"{home}/in", run)
    topic = _table_of(feeds.topic_records(spark, f"{home}/topic"))
    return Q.reconcile_summary(topic, keyed.rows(), D.LINE_KEY, values)


# -- star view -----------------------------------------------------------------------------

@query
def star_join(spark, sf_dir):
    joined = star.star_join(D.fact(lines(spark, sf_dir)), *dims(spark, sf_dir))
    return joined.select("ss_store_sk", "s_store_name", "s_state", "d_date", "ss_ticket_number",
                         "ss_quantity", "ss_net_paid_inc_tax")


@query
def daily_store_view(spark, sf_dir):
    return star.daily_store_view(D.fact(lines(spark, sf_dir)), *dims(spark, sf_dir))


def fact_view(spark, home):
    """The view over lines: images of lines become images of facts first."""
    return MaintainedView(spark, home, D.FACT, buckets=8, to_fact=D.fact)


@query
def daily_store_view_ivm(spark, sf_dir):
    """The view over the final state of the feed, kept up batch by batch: the snapshot, then
    three batches of changes without before-images."""
    home = fresh_dir(spark, "ivm")
    keyed, view = keyed_table(spark, f"{home}/table"), fact_view(spark, f"{home}/view")
    for batch_id, part in enumerate(line_parts(spark, sf_dir)):
        batch = D.line_changes(part)
        apply_to_both(batch, batch_id, keyed, view)
        apply_to_both(batch, batch_id, keyed, view)  # a repeated delivery changes nothing
    return view.rows(*dims(spark, sf_dir))


@query
def daily_store_view_stream(spark, sf_dir):
    """The feed as a stream that keeps both the table and the view over it."""
    home = fresh_dir(spark, "view-stream")
    keyed, view = keyed_table(spark, f"{home}/table"), fact_view(spark, f"{home}/view")
    feed = D.line_changes(D.table_stream(spark, sf_dir, "lineitem", maxBytesPerTrigger=str(256 * 2**30)))
    jobs.for_each_batch(feed, jobs.view_writer(keyed, view), "daily_store_view_stream", f"{home}/checkpoint",
                        availableNow=True).awaitTermination()
    return view.rows(*dims(spark, sf_dir))


@query
def star_join_stream(spark, sf_dir):
    """A stream of facts joined with the dimensions as they are."""
    facts = D.fact(D.table_stream(spark, sf_dir, "lineitem"))
    joined = star.star_join(facts, *dims(spark, sf_dir)).select(
        "ss_store_sk", "s_state", "d_date", "ss_ticket_number", "ss_quantity")
    return _stream_to_table(joined, "star_join_stream")


@query
def view_from_row_images(spark, sf_dir):
    """The view kept up by changes with both images, no look-up in the fact table."""
    old, new = versions(spark, sf_dir)
    view = fact_view(spark, fresh_dir(spark, "ivm-images"))
    view.apply(old.withColumn("op", F.lit(C.INSERT)), 0)
    view.apply(C.split_images(C.diff_changes(old, new, D.LINE_KEY), []), 1)
    return view.rows(*dims(spark, sf_dir))


@query
def view_rebuild(spark, sf_dir):
    """The view dropped and computed again from the current table."""
    old, new = versions(spark, sf_dir)
    view = fact_view(spark, fresh_dir(spark, "rebuild"))
    view.apply(old.withColumn("op", F.lit(C.INSERT)), 0)
    view.rebuild(new)
    return view.rows(*dims(spark, sf_dir))


# -- warehouse shapes, keys, checks --------------------------------------------------------

def _store_sales(spark, sf_dir):
    """Lines under the column names of the sales source."""
    money = lambda c: F.col(c).cast("decimal(12,2)")
    return lines(spark, sf_dir).select(
        D.line_op().alias("op"),
        F.when(F.col("l_linestatus") == "O", F.timestamp_seconds(F.lit(0)))
        .otherwise(F.col("l_shipdate").cast("timestamp")).alias("op_ts"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_partkey").cast("int").alias("ss_item_sk"), F.col("l_orderkey").cast("int").alias("ss_customer_sk"),
        F.col("l_suppkey").cast("int").alias("ss_store_sk"), F.col("l_orderkey").alias("ss_ticket_number"),
        F.col("l_quantity").cast("int").alias("ss_quantity"),
        (money("l_extendedprice") * F.lit("0.10").cast("decimal(3,2)")).cast("decimal(12,2)").alias("ss_sales_price"),
        money("l_extendedprice").alias("ss_ext_sales_price"),
        (money("l_extendedprice") * F.lit("0.25").cast("decimal(3,2)")).alias("ss_net_profit"),
        F.col("l_shipdate").cast("timestamp").alias("created_at"),
        (F.col("l_shipdate").cast("timestamp") + F.expr("interval 1 day")).alias("updated_at"),
    )


def _loaded():
    """A fixed load time."""
    return F.lit("2030-01-01").cast("timestamp")


@query
def warehouse_projection(spark, sf_dir):
    return shapes.to_warehouse(_store_sales(spark, sf_dir).drop("op", "op_ts"), _loaded())


@query
def unkeyed_warehouse_projection(spark, sf_dir):
    return shapes.to_warehouse(_store_sales(spark, sf_dir).drop("op", "op_ts"), _loaded(), keyed=False)


@query
def event_projection(spark, sf_dir):
    return shapes.to_sales_event(_store_sales(spark, sf_dir), _loaded())


@query
def cdc_monitor(spark, sf_dir):
    return shapes.sales_monitor(_store_sales(spark, sf_dir))


@query
def returns_monitor(spark, sf_dir):
    returned = _store_sales(spark, sf_dir).select(
        "op", "op_ts", "id", F.col("ss_ticket_number").alias("sr_ticket_number"), F.col("ss_item_sk").alias("sr_item_sk"),
        F.col("ss_customer_sk").alias("sr_customer_sk"), F.col("ss_quantity").alias("sr_return_quantity"),
        F.col("ss_ext_sales_price").alias("sr_return_amt"), F.col("ss_net_profit").alias("sr_net_loss"))
    return shapes.returns_monitor(returned.filter(F.col("op") == C.DELETE))


@query
def not_null_enforced(spark, sf_dir):
    """Lines without a discount or tax stand for rows with a missing value."""
    gaps = lines(spark, sf_dir).select(
        *D.LINE_KEY, F.expr("nullif(l_discount, 0D)").alias("l_discount"), F.expr("nullif(l_tax, 0D)").alias("l_tax"))
    return C.drop_null_rows(gaps, ["l_discount", "l_tax"])


@query
def clone_and_copy(spark, sf_dir):
    """An empty table of the same shape, then the rows."""
    source, path = lines(spark, sf_dir), fresh_dir(spark, "clone")
    sinks.clone_shape(source).write.parquet(path)
    source.write.mode("append").parquet(path)
    return spark.read.schema(source.schema).parquet(path)


@query
def surrogate_key(spark, sf_dir):
    return R.with_dense_id(lines(spark, sf_dir), [*D.LINE_ORDER, *D.LINE_KEY], "ss_id") \
        .select("ss_id", *D.LINE_KEY, *D.LINE_ORDER)


@query
def point_lookup(spark, sf_dir):
    """The lines of many given keys: those of urgent orders."""
    urgent = D.table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return lines(spark, sf_dir).join(
        urgent.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi") \
        .select(*D.LINE_KEY, "l_partkey", "l_extendedprice")


@query
def lookup_by_key(spark, sf_dir):
    """The versions of one given line; the key reaches the scan."""
    return lines(spark, sf_dir).filter((F.col("l_orderkey") == 7) & (F.col("l_linenumber") == 1)) \
        .select(*D.LINE_KEY, "l_partkey", "l_shipdate", "l_extendedprice")


@query
def target_lifecycle(spark, sf_dir):
    """A target that is made, filled, made again (it stays) and recreated (it is empty)."""
    source, name = D.table(spark, sf_dir, "orders"), f"target_{uuid.uuid4().hex}"
    steps = {"missing": lambda: None, "made": lambda: sinks.create_target(spark, name, source.schema),
             "filled": lambda: sinks.copy_into(source, name),
             "made again": lambda: sinks.create_target(spark, name, source.schema),
             "recreated": lambda: sinks.create_target(spark, name, source.schema, recreate=True),
             "dropped": lambda: spark.sql(f"DROP TABLE {name}")}
    seen = []
    for step, act in steps.items():
        act()
        status = Q.target_status(spark, name)
        seen.append((step, status, spark.table(name).count() if status == "EXISTS" else None))
    return spark.createDataFrame(seen, "step string, status string, row_count bigint")


@query
def exact_amounts(spark, sf_dir):
    """The amounts of the store view as decimal text: every digit counts, and so does the scale."""
    view = star.daily_store_view(D.fact(lines(spark, sf_dir)), *dims(spark, sf_dir))
    return view.select("ss_store_sk", "sold_date_sk", *[
        F.col(c).cast("string").alias(c) for c in ("total_sales_amount", "total_net_profit")])


@query
def table_counts(spark, sf_dir):
    counts = [D.table(spark, sf_dir, name).agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
              for name in D.SCHEMAS]
    total = counts[0]
    for one in counts[1:]:
        total = total.unionByName(one)
    return total


@query
def sync_profile(spark, sf_dir):
    return Q.profile(D.warehouse_sales(lines(spark, sf_dir)), "source_id", "ss_item_sk", "ss_ext_sales_price",
                     "sync_timestamp")


def _warehouse_returns(spark, sf_dir):
    """Returns in the warehouse shape, as if each had been loaded a day after its last update."""
    returned = D.wide_returns(lines(spark, sf_dir)).drop("op")
    loaded = date_of_compact_key(F.col("sr_returned_date_sk")).cast("timestamp") + F.expr("interval 1 day")
    return shapes.to_warehouse(returned, loaded)


@query
def returns_profile(spark, sf_dir):
    return Q.profile(_warehouse_returns(spark, sf_dir), "source_id", "sr_item_sk", "sr_return_amt", "sync_timestamp")


@query
def recent_returns(spark, sf_dir):
    returns = _warehouse_returns(spark, sf_dir).select(
        "source_id", "sr_item_sk", "sr_ticket_number", "sr_return_quantity", "sr_return_amt", "sync_timestamp")
    return R.newest(returns, ["sync_timestamp", "source_id", "sr_item_sk", "sr_return_quantity", "sr_return_amt"], 5)


@query
def load_stamps(spark, sf_dir):
    """Without a given load time, all rows of a load carry the same current one."""
    loaded = shapes.to_warehouse(D.wide_returns(lines(spark, sf_dir)).drop("op"))
    return loaded.agg(F.count("sync_timestamp").alias("stamped_rows"),
                      F.count_distinct("sync_timestamp").alias("stamps"),
                      (F.max("sync_timestamp") <= F.current_timestamp()).alias("not_ahead"))


@query
def local_load_stamps(spark, sf_dir):
    """Load times without a zone, as a target without zones keeps them."""
    loaded = shapes.to_warehouse(D.wide_returns(lines(spark, sf_dir)).drop("op"), F.localtimestamp())
    return loaded.agg(F.count("sync_timestamp").alias("stamped_rows"),
                      F.count_distinct("sync_timestamp").alias("stamps")).withColumn(
        "stamp_type", F.lit(loaded.schema["sync_timestamp"].dataType.simpleString()))


@query
def recent_rows(spark, sf_dir):
    sales = D.warehouse_sales(lines(spark, sf_dir))
    return R.newest(sales, ["sync_timestamp", "source_id", "ss_item_sk", "ss_quantity", "ss_ext_sales_price"], 5)


@query
def newest_row(spark, sf_dir):
    return R.newest(D.table(spark, sf_dir, "events").select("event_id", "ts", "event_type"), ["event_id"], 1)


@query
def peek_changes(spark, sf_dir):
    """Any five changes."""
    return D.line_changes(lines(spark, sf_dir)).limit(5)


@query
def key_uniqueness(spark, sf_dir):
    """The verdict for a table with repeated keys and for its materialized state."""
    raw = D.warehouse_sales(lines(spark, sf_dir))
    state = D.warehouse_sales(C.materialize(D.line_changes(lines(spark, sf_dir)), D.LINE_KEY, D.LINE_ORDER))
    return Q.key_check(raw, "source_id").withColumn("table_name", F.lit("feed")).unionByName(
        Q.key_check(state, "source_id").withColumn("table_name", F.lit("state")))


@query
def source_target_diff(spark, sf_dir):
    """An older version of the table against the current one, key by key."""
    old, new = versions(spark, sf_dir)
    return Q.reconcile(new, old, D.LINE_KEY, D.LINE_ROW.names)


@query
def tz_convert(spark, sf_dir):
    return D.table(spark, sf_dir, "events").select(
        "event_id", to_zone(F.col("ts"), "Asia/Shanghai", "UTC").alias("utc_time"),
        to_zone(F.col("ts"), "UTC", "Asia/Shanghai").alias("local_time"))


@query
def tz_offset_check(spark, sf_dir):
    """Clicks carry local time where UTC is due; all others agree up to some seconds."""
    shifted = F.when(F.col("event_type") == "click", to_zone(F.col("ts"), "UTC", "Asia/Shanghai")) \
        .otherwise(F.col("ts") + F.expr("interval 20 seconds"))
    return Q.clock_shifts(D.table(spark, sf_dir, "events").withColumn("seen", shifted), "seen", "ts")


@query
def tz_offset_hours(spark, sf_dir):
    return D.table(spark, sf_dir, "events").groupBy(
        "event_type", hours_between(F.col("ts"), to_zone(F.col("ts"), "UTC", "Asia/Shanghai")).alias("offset_hours")
    ).agg(F.count("*").alias("row_count"))


@query
def date_keys(spark, sf_dir):
    """Both kinds of date key, back to dates, and second of day."""
    day = F.col("ts").cast("date")
    keys = D.table(spark, sf_dir, "events").select(
        "event_id", compact_date_key(day).alias("compact_key"), julian_date_key(day).alias("julian_key"),
        second_of_day(F.col("ts")).alias("time_key"))
    return keys.withColumns({
        "from_compact": date_of_compact_key(F.col("compact_key")), "from_julian": date_of_julian_key(F.col("julian_key")),
        "unified_key": julian_key_of(F.col("compact_key"))})


@query
def scalar_functions(spark, sf_dir):
    """Casts, concatenation, CASE, COALESCE, exact arithmetic, ROUND, FLOOR, LEAST."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    size = F.when(F.col("l_quantity") > 40, "LARGE").when(F.col("l_quantity") > 20, "MEDIUM").otherwise("SMALL")
    return lines(spark, sf_dir).select(
        *D.LINE_KEY, F.concat(size, F.lit("-"), F.col("l_suppkey").cast("string")).alias("tag"),
        F.coalesce(F.when(F.col("l_returnflag") == "R", F.col("l_linestatus")), F.lit("none")).alias("returned_status"),
        (price * F.lit("0.08").cast("decimal(3,2)") + price).alias("with_tax"),
        F.round(price / F.lit(7), 2).cast("decimal(12,2)").alias("seventh"),
        F.floor(F.col("l_extendedprice") / 1000).cast("bigint").alias("thousands"),
        amounts.capped_return_quantity(F.lit(3), F.col("l_quantity").cast("int")).alias("returnable"),
        (F.col("l_shipdate") + F.expr("interval 5 minutes")).alias("plus_five"))


def _sale_inputs(spark, sf_dir):
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return lines(spark, sf_dir).select(
        *D.LINE_KEY, "l_shipdate", "l_partkey", F.col("l_quantity").cast("int").alias("quantity"),
        price.alias("list_price"),
        (price * F.lit("0.60").cast("decimal(3,2)")).cast("decimal(12,2)").alias("wholesale_cost"),
        (price * (F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(3,2)"))).cast("decimal(12,2)").alias("sales_price"),
        F.col("l_tax").cast("decimal(4,3)").alias("tax_rate"),
        F.when(F.col("l_discount") >= 0.05, F.lit("12.50")).otherwise(F.lit("0.00")).cast("decimal(7,2)").alias("coupon_amt"))


_SALE_OUT = [*D.LINE_KEY, "l_shipdate", "l_partkey", "quantity", "ext_discount_amt", "ext_sales_price", "ext_wholesale_cost",
             "ext_list_price", "ext_tax", "net_paid", "net_paid_inc_tax", "net_profit"]


@query
def sale_amounts(spark, sf_dir):
    return amounts.with_sale_amounts(_sale_inputs(spark, sf_dir)).select(*_SALE_OUT)


@query
def amount_recompute(spark, sf_dir):
    """Sales after an update that doubles the quantity and grants a coupon."""
    sold = amounts.with_sale_amounts(_sale_inputs(spark, sf_dir))
    updated = sold.withColumns({"quantity": F.col("quantity") * 2, "coupon_amt": F.lit("20.00").cast("decimal(7,2)")})
    return amounts.with_amounts_after_update(updated).select(*_SALE_OUT)


@query
def amount_recompute_paid_only(spark, sf_dir):
    """The same update where only the paid amounts follow."""
    sold = amounts.with_sale_amounts(_sale_inputs(spark, sf_dir))
    updated = sold.withColumns({"quantity": F.col("quantity") * 2, "coupon_amt": F.lit("20.00").cast("decimal(7,2)")})
    return amounts.with_amounts_after_update(updated, paid_only=True).select(*_SALE_OUT)


@query
def return_amounts(spark, sf_dir):
    cents = lambda text: F.lit(text).cast("decimal(7,2)")
    inputs = lines(spark, sf_dir).select(
        *D.LINE_KEY, "l_shipdate", "l_partkey", F.col("l_extendedprice").cast("decimal(12,2)").alias("return_amt"),
        F.col("l_tax").cast("decimal(4,3)").alias("tax_rate"), cents("4.25").alias("fee"), cents("9.75").alias("ship_cost"),
        (F.col("l_discount").cast("decimal(4,2)") * 8).cast("decimal(4,2)").alias("cash_share"),
        (F.col("l_discount").cast("decimal(4,2)") * 7).cast("decimal(4,2)").alias("reversed_share"))
    return amounts.with_return_amounts(inputs).drop("tax_rate", "fee", "ship_cost", "cash_share", "reversed_share")
