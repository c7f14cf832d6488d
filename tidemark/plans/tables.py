"""The test tables, and the shapes that the model's operators take, derived from them.

``events`` stands for the sales and returns streams, ``lineitem`` for the fact table and, as its
keys repeat, for a feed of changes. Everything here is a plain projection of whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.temporal import compact_date_key, julian_date_key
from ..schemas import STORE_RETURNS, STORE_SALES, columns
from ..sources.feeds import file_stream

SCHEMAS = {
    "region": columns("r_regionkey:int r_name:string"),
    "nation": columns("n_nationkey:int n_name:string n_regionkey:int"),
    "supplier": columns("s_suppkey:long s_name:string s_nationkey:int s_acctbal:double"),
    "customer": columns("c_custkey:long c_name:string c_nationkey:int c_acctbal:double c_mktsegment:string"),
    "part": columns("p_partkey:long p_name:string p_brand:string p_type:string p_size:int p_retailprice:double"),
    "orders": columns("o_orderkey:long o_custkey:long o_orderstatus:string o_totalprice:double"
                      " o_orderdate:local_time o_orderpriority:string"),
    "lineitem": columns("l_orderkey:long l_partkey:long l_suppkey:long l_linenumber:int l_quantity:double"
                        " l_extendedprice:double l_discount:double l_tax:double l_returnflag:string"
                        " l_linestatus:string l_shipdate:local_time"),
    "events": columns("event_id:long ts:local_time user_id:long event_type:string value:double props:string"),
}

LINE_KEY = ["l_orderkey", "l_linenumber"]
# Orders the versions of one line; no two versions agree on all of it.
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
LINE_ROW = columns("l_orderkey:long l_linenumber:int l_shipdate:local_time l_partkey:long l_suppkey:long"
                   " l_quantity:double l_extendedprice:double l_tax:double l_discount:double")

FACT = columns("ss_store_sk:int ss_sold_date_sk:int ss_ticket_number:long ss_quantity:int"
               " ss_net_paid_inc_tax:amount ss_net_profit:amount")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, **options: str) -> DataFrame:
    return file_stream(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name], **options)


def sales_events(events: DataFrame) -> DataFrame:
    price = F.col("value").cast("decimal(12,2)")
    return events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("id"), (F.col("user_id") % 10).cast("int").alias("store_sk"),
        F.col("user_id").alias("item_sk"), price.alias("ext_sales_price"),
        (price * F.lit("0.25").cast("decimal(3,2)")).alias("net_profit"),
        F.col("ts").alias("created_at"),
    )


def return_events(events: DataFrame) -> DataFrame:
    amount = F.col("value").cast("decimal(12,2)")
    return events.filter(F.col("event_type") == "error").select(
        F.col("event_id").alias("id"), (F.col("user_id") % 10).cast("int").alias("store_sk"),
        F.col("user_id").alias("item_sk"), amount.alias("return_amt"),
        (amount * F.lit("0.25").cast("decimal(3,2)")).alias("net_loss"),
        F.col("ts").alias("created_at"),
    )


def line_op():
    """Returned lines are deletes, shipped ones updates, open ones inserts."""
    return (F.when(F.col("l_returnflag") == "R", "-D")
            .when(F.col("l_linestatus") == "F", "+U").otherwise("+I"))


def line_changes(lineitem: DataFrame) -> DataFrame:
    """The change feed: one change per row, keyed by line, in LINE_ORDER."""
    return lineitem.select(line_op().alias("op"), *LINE_ROW.names)


def fact_columns() -> dict:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    one = F.lit(1).cast("decimal(3,2)")
    return {
        "ss_store_sk": F.col("l_suppkey").cast("int"),
        "ss_sold_date_sk": julian_date_key(F.col("l_shipdate")),
        "ss_ticket_number": F.col("l_orderkey"),
        "ss_quantity": F.col("l_quantity").cast("int"),
        "ss_net_paid_inc_tax": (price * (one + F.col("l_tax").cast("decimal(3,2)"))).cast("decimal(18,4)"),
        "ss_net_profit": (price * (F.lit("0.05").cast("decimal(3,2)") - F.col("l_discount").cast("decimal(3,2)")))
        .cast("decimal(18,4)"),
    }


def fact(lines: DataFrame) -> DataFrame:
    """Lines, or images of them with their ``op``, as sales facts."""
    keep = ["op"] if "op" in lines.columns else []
    return lines.select(*keep, *[c.alias(n) for n, c in fact_columns().items()])


def date_dim(orders: DataFrame) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return orders.select(day.alias("d_date")).distinct().select(
        julian_date_key(F.col("d_date")).alias("d_date_sk"), "d_date")


def store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").cast("int").alias("s_store_sk"), F.col("s_name").alias("s_store_name"),
                F.col("n_name").alias("s_state"), F.col("r_name").alias("s_market_manager"))
    )


def warehouse_sales(lineitem: DataFrame) -> DataFrame:
    """Lines in the keyed warehouse shape. The key repeats, as one line has several versions."""
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("source_id"),
        F.col("l_partkey").cast("int").alias("ss_item_sk"), F.col("l_orderkey").alias("ss_ticket_number"),
        F.col("l_quantity").cast("int").alias("ss_quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("ss_ext_sales_price"),
        F.col("l_shipdate").alias("sync_timestamp"),
    )


def _share(amount, share: str):
    return (amount * F.lit(share).cast("decimal(3,2)")).cast("decimal(7,2)")


def wide_sales(lineitem: DataFrame) -> DataFrame:
    """Lines with all 26 columns of the sales source; amounts are a tenth, to fit its types."""
    amount = _share(F.col("l_extendedprice").cast("decimal(12,2)"), "0.10")
    shares = {
        "ss_wholesale_cost": "0.50", "ss_list_price": "1.00", "ss_sales_price": "0.90", "ss_ext_discount_amt": "0.10",
        "ss_ext_sales_price": "0.95", "ss_ext_wholesale_cost": "0.55", "ss_ext_list_price": "1.05", "ss_ext_tax": "0.08",
        "ss_coupon_amt": "0.01", "ss_net_paid": "0.94", "ss_net_paid_inc_tax": "1.02", "ss_net_profit": "0.39",
    }
    shipped = F.col("l_shipdate").cast("timestamp")
    plain = {
        "id": F.col("l_orderkey") * 10 + F.col("l_linenumber"), "ss_sold_date_sk": compact_date_key(F.col("l_shipdate")),
        "ss_sold_time_sk": F.col("l_quantity") * 60, "ss_item_sk": F.col("l_partkey"), "ss_customer_sk": F.col("l_orderkey"),
        "ss_cdemo_sk": F.col("l_linenumber"), "ss_hdemo_sk": F.col("l_linenumber") + 1, "ss_addr_sk": F.col("l_suppkey"),
        "ss_store_sk": F.col("l_suppkey"), "ss_promo_sk": F.col("l_linenumber") * 2, "ss_ticket_number": F.col("l_orderkey"),
        "ss_quantity": F.col("l_quantity"), "created_at": shipped, "updated_at": shipped,
        **{name: _share(amount, share) for name, share in shares.items()},
    }
    return lineitem.select(line_op().alias("op"), *[plain[f.name].cast(f.dataType).alias(f.name) for f in STORE_SALES])


def wide_returns(lineitem: DataFrame) -> DataFrame:
    """Returned lines with all 23 columns of the returns source."""
    amount = _share(F.col("l_extendedprice").cast("decimal(12,2)"), "0.10")
    shares = {
        "sr_return_amt": "0.90", "sr_return_tax": "0.07", "sr_return_amt_inc_tax": "0.97", "sr_fee": "0.01",
        "sr_return_ship_cost": "0.02", "sr_refunded_cash": "0.50", "sr_reversed_charge": "0.30", "sr_store_credit": "0.17",
        "sr_net_loss": "0.93",
    }
    shipped = F.col("l_shipdate").cast("timestamp")
    plain = {
        "id": F.col("l_orderkey") * 10 + F.col("l_linenumber"), "sr_returned_date_sk": compact_date_key(F.col("l_shipdate")),
        "sr_return_time_sk": F.col("l_quantity") * 60, "sr_item_sk": F.col("l_partkey"), "sr_customer_sk": F.col("l_orderkey"),
        "sr_cdemo_sk": F.col("l_linenumber"), "sr_hdemo_sk": F.col("l_linenumber") + 1, "sr_addr_sk": F.col("l_suppkey"),
        "sr_store_sk": F.col("l_suppkey"), "sr_reason_sk": F.col("l_linenumber") * 2, "sr_ticket_number": F.col("l_orderkey"),
        "sr_return_quantity": F.col("l_quantity"), "created_at": shipped, "updated_at": shipped,
        **{name: _share(amount, share) for name, share in shares.items()},
    }
    returned = lineitem.filter(F.col("l_returnflag") == "R")
    return returned.select(F.lit("+I").alias("op"), *[plain[f.name].cast(f.dataType).alias(f.name) for f in STORE_RETURNS])


def as_envelopes(changes: DataFrame, table_name: str) -> DataFrame:
    """Changes as JSON envelopes that carry the one image they have."""
    row = F.struct(*[c for c in changes.columns if c != "op"])
    return changes.select(F.to_json(F.struct(
        "op", F.col("id").alias("seq"), F.col("updated_at").alias("op_ts"), F.lit("business_db").alias("db_name"),
        F.lit(table_name).alias("table_name"), F.when(F.col("op") == "-D", row).alias("before"),
        F.when(F.col("op") != "-D", row).alias("after"))).alias("value"))


def presentable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, instants as zone-less times, dates as text, all integers long."""
    def shown(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double")
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz")
        if isinstance(field.dataType, T.DateType):
            return column.cast("string")
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return column.cast("bigint")
        return column
    return df.select(*[shown(f).alias(f.name) for f in df.schema.fields])
