"""Dates, zones, amounts, ranking, checks."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tidemark.functions import amounts
from tidemark.functions.temporal import (compact_date_key, date_of_compact_key, date_of_julian_key, hours_between,
                                         julian_date_key, julian_key_of, second_of_day, to_zone, whole_hour_shift)
from tidemark.operators import quality as Q, ranking as R
from tidemark.operators.windows import first_by_time, hopping_sums


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_zone_conversion(spark):
    local = F.lit("2025-06-27 15:53:21").cast("timestamp_ntz")
    row = one(spark, to_zone(local, "Asia/Shanghai", "UTC").alias("u"),
              hours_between(to_zone(local, "Asia/Shanghai", "UTC"), local).alias("h"))
    assert row.u == dt.datetime(2025, 6, 27, 7, 53, 21) and row.h == 8


def test_clock_shift(spark):
    ts = lambda t: F.lit(t).cast("timestamp_ntz")
    row = one(spark, whole_hour_shift(ts("2025-01-01 08:00:30"), ts("2025-01-01 00:00:00")).alias("a"),
              whole_hour_shift(ts("2025-01-01 00:30:00"), ts("2025-01-01 00:00:00")).alias("b"),
              whole_hour_shift(ts("2025-01-01 00:00:00"), ts("2025-01-01 08:00:00")).alias("c"))
    assert tuple(row) == (8, None, -8)


def test_date_keys(spark):
    day = F.lit("2024-01-01").cast("date")
    row = one(spark, compact_date_key(day).alias("a"), julian_date_key(day).alias("b"),
              date_of_compact_key(F.lit(20240101)).alias("c"), date_of_julian_key(F.lit(2460311)).alias("d"),
              julian_key_of(F.lit(20240101)).alias("e"), julian_key_of(F.lit(2460311)).alias("f"),
              second_of_day(F.lit("2024-01-01 10:00:05").cast("timestamp")).alias("g"))
    date = dt.date(2024, 1, 1)
    assert tuple(row) == (20240101, 2460311, date, date, 2460311, 2460311, 36005)


def test_seed_sales_amounts(spark):
    rows = [(2, "89.99", "45.50", "79.99"), (3, "49.99", "25.00", "44.99"), (2, "149.99", "80.00", "129.99")]
    money = lambda c: F.col(c).cast("decimal(7,2)").alias(c)
    df = spark.createDataFrame(rows, "quantity int, list_price string, wholesale_cost string, sales_price string") \
        .select("quantity", money("list_price"), money("wholesale_cost"), money("sales_price"),
                F.lit("0.08").cast("decimal(4,3)").alias("tax_rate"), F.lit("0").cast("decimal(7,2)").alias("coupon_amt"))
    got = amounts.with_sale_amounts(df).collect()
    assert [str(r.ext_sales_price) for r in got] == ["159.98", "134.97", "259.98"]
    assert [str(r.net_profit) for r in got] == ["68.98", "59.97", "99.98"]
    assert str(got[0].net_paid_inc_tax) == str(Decimal("172.7784").quantize(Decimal("0.01"), ROUND_HALF_UP))
    after = amounts.with_amounts_after_update(
        amounts.with_sale_amounts(df).withColumn("quantity", F.lit(10)), paid_only=True).first()
    assert (str(after.ext_sales_price), str(after.net_profit), str(after.ext_list_price)) == ("799.90", "68.98", "179.98")


def test_refund_parts_add_up(spark):
    rng = random.Random(5)
    rows = [(f"{rng.uniform(10, 200):.2f}", f"{rng.uniform(.05, .15):.3f}", f"{rng.uniform(0, .8):.2f}", f"{rng.uniform(0, .7):.2f}")
            for _ in range(200)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string").select(
        F.col("a").cast("decimal(7,2)").alias("return_amt"), F.col("b").cast("decimal(4,3)").alias("tax_rate"),
        F.col("c").cast("decimal(4,2)").alias("cash_share"), F.col("d").cast("decimal(4,2)").alias("reversed_share"),
        F.lit("5.00").cast("decimal(7,2)").alias("fee"), F.lit("7.00").cast("decimal(7,2)").alias("ship_cost"))
    out = amounts.with_return_amounts(df)
    assert out.filter("refunded_cash + reversed_charge + store_credit <> return_amt_inc_tax").count() == 0
    assert out.filter("net_loss <> return_amt + 12").count() == 0


def test_dense_ids_when_one_value_leads_most_rows(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 < 2, F.lit(7)).otherwise(F.col("id") % 100).alias("v"), "id")
    got = [(r.n, r.v, r.id) for r in R.with_dense_id(rows, ["v", "id"], "n", partitions=6).collect()]
    want = sorted((7 if i % 3 < 2 else i % 100, i) for i in range(20_000))
    assert sorted(got) == [(n + 1, *row) for n, row in enumerate(want)]


def test_dense_ids_of_nothing(spark):
    assert R.with_dense_id(spark.range(0), ["id"], "n").count() == 0


def test_first_value_skips_unknown_and_breaks_ties_by_id(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(t, 5, None), (t + dt.timedelta(seconds=1), 4, 40), (t + dt.timedelta(seconds=1), -3, 30),
            (dt.datetime(1969, 1, 1), 9, None)]
    df = spark.createDataFrame(rows, "event_time timestamp, id long, item int")
    assert df.agg(first_by_time("item").alias("f")).first().f == 30


def test_hopping_by_slides_equals_direct_assignment(spark):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(seconds=rng.random() * 4000), rng.choice([1, 1, 1, 2, 3]), rng.randrange(100)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "event_time timestamp, k int, x int")
    for size, slide in (("5 minutes", "1 minute"), ("5 minutes", "2 minutes"), ("1 minute", "1 minute")):
        got = hopping_sums(df, "k", {"n": None, "s": F.col("x")}, size, slide)
        direct = df.groupBy(F.window("event_time", size, slide), "k").agg(F.count("*").alias("n"), F.sum("x").alias("s"))
        assert sorted(map(str, got.collect())) == sorted(map(str, direct.collect()))


def test_reconcile_finds_every_difference(spark):
    a = spark.createDataFrame([(1, 1, 2), (2, 1, None), (3, 3, 3), (5, 1, 1), (5, 1, 1), (6, 1, 2), (6, 3, 4)], "k int, x int, y int")
    b = spark.createDataFrame([(1, 1, 2), (2, None, 1), (4, 4, 4), (5, 1, 1), (6, 3, 4), (6, 1, 2)], "k int, x int, y int")
    got = {r.k: r.status for r in Q.reconcile(a, b, ["k"], ["k", "x", "y"]).collect()}
    assert got == {1: "same", 2: "different", 3: "missing", 4: "extra", 5: "different", 6: "same"}


def test_key_check_and_target_status(spark, home):
    check = lambda rows: Q.key_check(spark.createDataFrame(rows, "k int"), "k").first().key_status
    assert check([(1,), (2,)]) == "主键唯一" and check([(1,), (1,)]) == "存在重复主键"
    assert Q.target_status(spark, home) == "EXISTS" and Q.target_status(spark, f"{home}/none") == "NOT EXISTS"
    assert Q.target_status(spark, "no_such_table") == "NOT EXISTS"
