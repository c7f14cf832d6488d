"""Queries on feeds and targets: snapshots while changes arrive, late starts, digests, with their SQL."""

from __future__ import annotations

from pyspark.sql import Observation, functions as F

from ..operators import changes as C
from ..operators.digests import digest_diff as by_digests
from ..operators.snapshots import chunked_snapshot as merge_chunks, key_chunks
from ..schemas import columns
from ..session import fresh_dir
from ..sources import feeds
from ..streaming import jobs
from ..streaming.ends import MaintainedEnds
from ..streaming.snapshots import SnapshotStream
from . import tables as D
from .oracle import CURRENT, ORACLE, state
from .queries import in_turns, keyed_table, line_parts, lines, query, versions

_DAY = 86_400
_FIRST_READ = 820_454_400  # 1996-01-01


def _positions(sf_lines):
    """The feed with its position: the day of the change, in seconds."""
    day = F.coalesce(F.unix_seconds(F.col("l_shipdate").cast("timestamp")), F.lit(0))
    return D.line_changes(sf_lines).withColumn("seq", day)


@query
def chunked_snapshot(spark, sf_dir):
    """Ranges of the order key that are read one after another in the course of the feed, each over
    some months in which its rows are read at different moments; then the table at the feed's end."""
    feed = _positions(lines(spark, sf_dir))
    chunks = key_chunks(feed, "l_orderkey", 2048)
    step = (5 * 365 * _DAY) // chunks.count
    brackets = spark.range(chunks.count).select(
        F.col("id").cast("int").alias("chunk"), (F.col("id") * step + _FIRST_READ).alias("low"),
        (F.col("id") * step + _FIRST_READ + 90 * _DAY).alias("high"))
    # A row is read some days after its chunk's low position, up to the high one.
    moment = _FIRST_READ + chunks.number() * F.lit(step) + F.pmod(F.xxhash64(*D.LINE_KEY), F.lit(91)) * _DAY
    read = C.materialize(feed.filter(F.col("seq") <= moment), D.LINE_KEY, D.LINE_ORDER).drop("op", "seq")
    merged = merge_chunks(read, feed, brackets, chunks, D.LINE_KEY, D.LINE_ORDER)
    return C.materialize(merged, D.LINE_KEY, ["seq", *D.LINE_ORDER]).drop("op", "seq")


@query
def chunked_snapshot_stream(spark, sf_dir):
    """The same while a stream runs: after each of its batches some chunks are read, when the table
    is half a year ahead of the batch, and handed on with the next batch to a keyed table."""
    home = fresh_dir(spark, "chunked")
    target = keyed_table(spark, f"{home}/table")
    chunks = key_chunks(lines(spark, sf_dir), "l_orderkey", 8192, most=8)
    now = {"turn": 0}

    def read(first: int, until: int):
        seen = F.coalesce(F.col("l_shipdate") < F.lit(f"{1998 + now['turn']}-07-01").cast("timestamp_ntz"), F.lit(True))
        part = lines(spark, sf_dir).filter(seen & chunks.between(first, until))
        return C.materialize(D.line_changes(part), D.LINE_KEY, D.LINE_ORDER).drop("op")

    snapshot = SnapshotStream(spark, home, chunks, -(-chunks.count // 2), read, D.LINE_KEY, D.LINE_ORDER)

    def run(turn: int) -> None:
        now["turn"] = turn
        feed = D.line_changes(feeds.file_stream(spark, f"{home}/in", D.SCHEMAS["lineitem"]))
        jobs.for_each_batch(feed, snapshot.writer(jobs.table_writer(target)), "chunked_snapshot_stream",
                            f"{home}/checkpoint", availableNow=True).awaitTermination()

    in_turns(line_parts(spark, sf_dir), f"{home}/in", run)
    return target.rows()


@query
def digest_diff(spark, sf_dir):
    """An older version of the table against the current one: the keys that differ, by digests."""
    home = fresh_dir(spark, "digest-diff")
    sides = []
    for name, version in zip(("old", "new"), versions(spark, sf_dir)):
        version.write.parquet(f"{home}/{name}")
        sides.append(spark.read.schema(version.schema).parquet(f"{home}/{name}"))
    return by_digests(sides[1], sides[0], D.LINE_KEY, D.LINE_ROW.names)


@query
def latest_start_stream(spark, sf_dir):
    """A stream over a folder that holds the oldest part of the feed when it is first started; three
    more parts come, with a stop after each."""
    home = fresh_dir(spark, "latest")
    first, *later = line_parts(spark, sf_dir)
    first.write.parquet(f"{home}/in")
    wanted = [*D.LINE_KEY, "l_shipdate", "l_partkey"]

    def run() -> None:
        stream = feeds.from_now_on(spark, f"{home}/in", D.SCHEMAS["lineitem"], home).select(*wanted)
        jobs.append_to_parquet(stream, f"{home}/out", "latest_start_stream", f"{home}/checkpoint", availableNow=True).awaitTermination()

    run()
    for part in later:
        part.write.mode("append").parquet(f"{home}/in")
        run()
    return spark.read.schema(lines(spark, sf_dir).select(*wanted).schema).parquet(f"{home}/out")


@query
def not_null_counts(spark, sf_dir):
    """How many rows a target with NOT NULL columns took, and how many it would have rejected."""
    counts, path = Observation("not_null"), fresh_dir(spark, "not-null")
    gaps = lines(spark, sf_dir).select(
        *D.LINE_KEY, F.expr("nullif(l_discount, 0D)").alias("l_discount"), F.expr("nullif(l_tax, 0D)").alias("l_tax"))
    kept = C.drop_null_rows(gaps, ["l_discount", "l_tax"], counts)
    kept.write.parquet(path)
    seen = counts.get
    return spark.read.schema(kept.schema).parquet(path).agg(
        F.lit(seen["rows"]).alias("rows_in"), F.lit(seen["dropped"]).alias("rows_dropped"), F.count("*").alias("rows_kept"))


_SALE_ROW = columns("store:long period:local_time l_shipdate:local_time l_orderkey:long l_linenumber:int l_partkey:long")


def _kept_ends(spark, sf_dir, period: str, keep: int):
    """First and last sale per store and period over the feed in four batches without before-images."""
    home = fresh_dir(spark, "ends")
    keyed = keyed_table(spark, f"{home}/table")
    ends = MaintainedEnds(spark, f"{home}/ends", _SALE_ROW, ["store", "period"], ["l_shipdate", "l_orderkey", "l_linenumber"], keep, 4)
    def sales(rows):
        kept = ["op"] if "op" in rows.columns else []
        return rows.select(*kept, F.col("l_suppkey").alias("store"), F.date_trunc(period, "l_shipdate").cast("timestamp_ntz").alias("period"),
                           "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    for batch_id, part in enumerate(line_parts(spark, sf_dir)):
        staged = keyed.stage(D.line_changes(part), batch_id)
        ends.apply(sales(keyed.images(staged)), sales(keyed.rows()), batch_id)
        keyed.table.commit(staged)
    return ends.rows().select(
        "store", "period", "n_rows", F.col("first.l_partkey").alias("first_item"), F.col("first.l_orderkey").alias("first_ticket"),
        F.col("first.l_shipdate").alias("first_sale"), F.col("last.l_orderkey").alias("last_ticket"),
        F.col("last.l_shipdate").alias("last_sale"))


@query
def store_day_ends(spark, sf_dir):
    return _kept_ends(spark, sf_dir, "day", 8)


@query
def store_month_ends(spark, sf_dir):
    """The same by month with a single row kept at each end, so that many of them run out."""
    return _kept_ends(spark, sf_dir, "month", 1)


def _ends(period: str) -> str:
    return f"""WITH {state()} SELECT l_suppkey AS store, date_trunc('{period}', l_shipdate) AS period, count(*) AS n_rows,
      arg_min(l_partkey, (l_shipdate, l_orderkey, l_linenumber)) AS first_item,
      arg_min(l_orderkey, (l_shipdate, l_orderkey, l_linenumber)) AS first_ticket, min(l_shipdate) AS first_sale,
      arg_max(l_orderkey, (l_shipdate, l_orderkey, l_linenumber)) AS last_ticket, max(l_shipdate) AS last_sale
      FROM state GROUP BY 1, 2"""


ORACLE |= {
    "store_day_ends": _ends("day"),
    "store_month_ends": _ends("month"),
    "digest_diff": f"SELECT * FROM ({ORACLE['source_target_diff']}) WHERE status <> 'same'",
    "latest_start_stream": """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_shipdate, l_partkey FROM lineitem
      WHERE year(l_shipdate) > 1997""",
    "not_null_counts": """SELECT count(*) AS rows_in, count(*) FILTER (l_discount = 0 OR l_tax = 0) AS rows_dropped,
      count(*) FILTER (l_discount <> 0 AND l_tax <> 0) AS rows_kept FROM lineitem""",
}
ORACLE |= {"chunked_snapshot": CURRENT, "chunked_snapshot_stream": CURRENT}
