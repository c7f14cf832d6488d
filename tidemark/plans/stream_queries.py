"""Queries with several stateful steps, several streams and several watermarks, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as X
from ..session import fresh_dir
from ..sources import feeds
from ..streaming import jobs
from ..streaming.metrics import batches, total_open
from ..streaming.pairs import PairedStreams
from . import tables as D
from .oracle import DAY, ORACLE, RETURNS, SALES, trends, SALES_SEEN
from .queries import decades, events_in_turns, line_parts, lines, query


@query
def item_trends_chained_stream(spark, sf_dir):
    """Item trends by two stateful steps: sums per slide, then windows of slides; stopped twice."""
    def trends_of(events):
        sales = X.with_event_time(D.sales_events(events))
        return X.item_trends(sales, size="1 day", slide="6 hours", chained=True)

    return events_in_turns(spark, sf_dir, "chained", decades(), {"trends": trends_of})["trends"]


def _turns_in_two_folders(spark, home: str, first: list, second: list):
    """Two folders as streams; before each turn, each gets its next part (or none)."""
    schemas = [next(p.schema for p in parts if p is not None) for parts in (first, second)]
    for folder, schema in zip("ab", schemas):
        spark.createDataFrame([], schema).write.parquet(f"{home}/{folder}")
    for turn in zip(first, second):
        for folder, part in zip("ab", turn):
            if part is not None:
                part.write.mode("append").parquet(f"{home}/{folder}")
        yield [feeds.file_stream(spark, f"{home}/{folder}", schema) for folder, schema in zip("ab", schemas)]


def _in_two_folders(spark, name: str, first: list, second: list, build, policy: str):
    """A stream over two folders that get their parts in turns. The stream stops after each turn and
    goes on from its checkpoint; what it wrote is read back."""
    home = fresh_dir(spark, name)
    result = None
    for sides in _turns_in_two_folders(spark, home, first, second):
        result = build(*sides)
        def start():
            return jobs.append_to_parquet(result, f"{home}/out", name, f"{home}/checkpoint", availableNow=True)

        jobs.with_watermark_policy(
            spark, policy, lambda: jobs.with_settings(spark, jobs.FEW_LARGE_BATCHES, start)).awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{home}/out")


@query
def returned_sales_stream(spark, sf_dir):
    """Sales and returns as two streams, joined by ticket and item within 30 days; sales without a
    return appear when the bound has passed. Returned lines come back as many days later as their quantity."""
    sold = lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("ss_ticket_number"), F.col("l_partkey").alias("ss_item_sk"),
        F.col("l_linenumber").alias("ss_line"), F.col("l_quantity").cast("int").alias("ss_quantity"), "l_shipdate")
    back = lines(spark, sf_dir).filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("sr_ticket_number"), F.col("l_partkey").alias("sr_item_sk"),
        F.col("l_linenumber").alias("sr_line"), F.col("l_quantity").cast("int").alias("sr_return_quantity"),
        (F.col("l_shipdate") + F.make_dt_interval(F.col("l_quantity").cast("int"))).alias("l_returned"))

    def by_year(df, day):
        part = F.least(F.greatest(F.coalesce(F.year(day), F.lit(0)) - 1997, F.lit(0)), F.lit(3))
        return [df.filter(part == n) for n in range(4)]

    home, pairs = fresh_dir(spark, "returned-sales"), None
    for sales, returns in _turns_in_two_folders(spark, home, by_year(sold, "l_shipdate"), by_year(back, "l_returned")):
        pairs = PairedStreams(
            X.with_event_time(sales, "l_shipdate", "sold_at").drop("l_shipdate"),
            X.with_event_time(returns, "l_returned", "returned_at").drop("l_returned"), f"{home}/pairs", policy="min",
            keep=["ss_ticket_number", "ss_item_sk", "ss_line", "ss_quantity", "sold_at",
                  "sr_line", "sr_return_quantity", "returned_at"])
        pairs.start("returned-sales", f"{home}/checkpoint", availableNow=True).awaitTermination()
    return pairs.rows()


@query
def true_return_rate_stream(spark, sf_dir):
    """Returns over sales from two streams of which the returns lag a turn behind, by either policy
    for the query's watermark: the slower stream's, or the faster one's."""
    events = D.table(spark, sf_dir, "events")
    sales, returns = D.sales_events(events), D.return_events(events)

    def parts(df):
        return [df.filter(part) for part in decades("created_at")]

    def rate(sold, back):
        return X.true_return_rate(X.with_event_time(sold), X.with_event_time(back), size="1 day")

    out = [_in_two_folders(spark, f"return-rate-{policy}", [*parts(sales), None], [None, *parts(returns)], rate, policy)
           .withColumn("policy", F.lit(policy)) for policy in ("min", "max")]
    return out[0].unionByName(out[1])


def _rates() -> str:
    """Turn by turn: the watermark that each leaves behind, which rows it finds late, what is closed at the end."""
    return f"""WITH {SALES}, {RETURNS},
      rows_in AS (
        SELECT 0 AS side, ts, store_sk, CASE WHEN day(ts) <= 10 THEN 0 WHEN day(ts) <= 20 THEN 1 ELSE 2 END AS turn FROM sales
        UNION ALL
        SELECT 1, ts, store_sk, CASE WHEN day(ts) <= 10 THEN 1 WHEN day(ts) <= 20 THEN 2 ELSE 3 END FROM returns),
      seen AS (SELECT turn, coalesce(max(ts) FILTER (side = 0), TIMESTAMP '1970-01-01 00:00:05') AS s,
          coalesce(max(ts) FILTER (side = 1), TIMESTAMP '1970-01-01 00:00:05') AS r
        FROM range(4) t(turn) LEFT JOIN rows_in USING (turn) GROUP BY turn),
      marks AS (SELECT policy, turn, max(CASE policy WHEN 'min' THEN least(s, r) ELSE greatest(s, r) END - INTERVAL 5 SECOND)
          OVER (PARTITION BY policy ORDER BY turn) AS mark FROM seen, (VALUES ('min'), ('max')) p(policy)),
      kept AS (SELECT m.policy, i.*, {DAY} AS w FROM rows_in i, (VALUES ('min'), ('max')) m(policy)
        LEFT JOIN marks b ON b.policy = m.policy AND b.turn = i.turn - 1
        WHERE b.mark IS NULL OR {DAY} + INTERVAL 1 DAY > b.mark),
      g AS (SELECT policy, w, store_sk, count(*) FILTER (side = 0) AS n, count(*) FILTER (side = 1) AS r FROM kept GROUP BY ALL)
      SELECT policy, w AS window_start, w + INTERVAL 1 DAY AS window_end, store_sk::BIGINT AS store_sk, n AS total_sales,
        r AS total_returns, CASE WHEN n > 0 THEN r::DOUBLE / n END AS return_rate
      FROM g JOIN marks USING (policy) WHERE turn = 3 AND w + INTERVAL 1 DAY <= mark"""


def _returned() -> str:
    return """WITH s AS (SELECT l_orderkey AS ss_ticket_number, l_partkey AS ss_item_sk, l_linenumber::BIGINT AS ss_line,
        l_quantity::BIGINT AS ss_quantity, l_shipdate AS sold_at FROM lineitem),
      r AS (SELECT l_orderkey AS t, l_partkey AS i, l_linenumber::BIGINT AS sr_line, l_quantity::BIGINT AS sr_return_quantity,
        l_shipdate + l_quantity::INTEGER * INTERVAL 1 DAY AS returned_at FROM lineitem WHERE l_returnflag = 'R'),
      mark AS (SELECT least((SELECT max(sold_at) FROM s), (SELECT max(returned_at) FROM r)) - INTERVAL 5 SECOND AS mark)
      SELECT s.*, sr_line, sr_return_quantity, returned_at FROM mark, s
        LEFT JOIN r ON t = ss_ticket_number AND i = ss_item_sk AND returned_at BETWEEN sold_at AND sold_at + INTERVAL 30 DAY
      WHERE returned_at IS NOT NULL OR sold_at + INTERVAL 30 DAY < mark"""


@query
def late_rows_counted(spark, sf_dir):
    """Store 3 reports when all others have. What came in, by observed counts; what is in closed
    windows, by the output; what is in open ones, by the state; and what was dropped as late."""
    home, events = fresh_dir(spark, "late-counted"), D.table(spark, sf_dir, "events")
    late = F.coalesce(F.col("user_id") % 10 == 3, F.lit(False))
    measured = []
    for turn, part in enumerate([events.filter(~late), events.filter(late)]):
        part.write.mode("append").parquet(f"{home}/in")
        sales = X.with_event_time(D.sales_events(feeds.file_stream(spark, f"{home}/in", events.schema)))
        counted = X.sales_counts(sales.observe("sales", F.count("*").alias("rows")), size="1 day")
        job = jobs.append_to_parquet(counted, f"{home}/out", "late_rows_counted", f"{home}/checkpoint", availableNow=True)
        job.awaitTermination()
        seen = batches(job)
        measured += [(turn, "rows_in", sum(b["observed"].get("sales", {}).get("rows", 0) for b in seen)),
                     (turn, "late_groups", sum(b["late_groups"] for b in seen))]
    closed = spark.read.schema(counted.schema).parquet(f"{home}/out").agg(F.coalesce(F.sum("total_sales"), F.lit(0))).first()[0]
    still_open = total_open(spark, f"{home}/checkpoint", F.col("value.count"))
    came = sum(n for _, measure, n in measured if measure == "rows_in")
    measured += [(1, "rows_closed", closed), (1, "rows_open", still_open), (1, "rows_dropped", came - closed - still_open)]
    return spark.createDataFrame(measured, "turn long, measure string, value long")


def _late_counts() -> str:
    return f"""WITH {SALES}, s AS (SELECT *, {DAY} + INTERVAL 1 DAY AS closes, (store_sk = 3)::BIGINT AS turn FROM sales),
      marks AS (SELECT max(ts) FILTER (turn = 0) - INTERVAL 5 SECOND AS first, max(ts) - INTERVAL 5 SECOND AS last FROM s),
      r AS (SELECT s.*, turn = 1 AND closes <= first AS late, closes <= last AS closed FROM s, marks)
      SELECT 0::BIGINT AS turn, 'rows_in' AS measure, count(*) FILTER (turn = 0) AS value FROM r
      UNION ALL SELECT 1, 'rows_in', count(*) FILTER (turn = 1) FROM r
      UNION ALL SELECT 0, 'late_groups', 0
      UNION ALL SELECT 1, 'late_groups', count(DISTINCT closes) FILTER (late) FROM r
      UNION ALL SELECT 1, 'rows_closed', count(*) FILTER (closed AND NOT late) FROM r
      UNION ALL SELECT 1, 'rows_open', count(*) FILTER (NOT closed AND NOT late) FROM r
      UNION ALL SELECT 1, 'rows_dropped', count(*) FILTER (late) FROM r"""


ORACLE |= {
    "late_rows_counted": _late_counts(),
    "item_trends_chained_stream": trends(f"AND w + INTERVAL 1 DAY <= {SALES_SEEN}"),
    "returned_sales_stream": _returned(),
    "true_return_rate_stream": _rates(),
}
