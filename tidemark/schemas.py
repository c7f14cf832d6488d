"""Declared schemas. Nothing is inferred: each reader passes one of these.

The column lists, types and keys below are fixed values of the data model.
"""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(),
    "date": T.DateType(), "instant": T.TimestampType(), "local_time": T.TimestampNTZType(),
    "money": T.DecimalType(7, 2), "amount": T.DecimalType(18, 4),
}


def columns(text: str) -> T.StructType:
    """``"id:long price:money"`` as a schema; needs no running session, unlike DDL text."""
    pairs = (word.split(":") for word in text.split())
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


STORE_SALES = columns("""
    id:long ss_sold_date_sk:int ss_sold_time_sk:int ss_item_sk:int ss_customer_sk:int
    ss_cdemo_sk:int ss_hdemo_sk:int ss_addr_sk:int ss_store_sk:int ss_promo_sk:int
    ss_ticket_number:long ss_quantity:int
    ss_wholesale_cost:money ss_list_price:money ss_sales_price:money
    ss_ext_discount_amt:money ss_ext_sales_price:money ss_ext_wholesale_cost:money
    ss_ext_list_price:money ss_ext_tax:money ss_coupon_amt:money ss_net_paid:money
    ss_net_paid_inc_tax:money ss_net_profit:money
    created_at:instant updated_at:instant
""")

STORE_RETURNS = columns("""
    id:long sr_returned_date_sk:int sr_return_time_sk:int sr_item_sk:int sr_customer_sk:int
    sr_cdemo_sk:int sr_hdemo_sk:int sr_addr_sk:int sr_store_sk:int sr_reason_sk:int
    sr_ticket_number:long sr_return_quantity:int
    sr_return_amt:money sr_return_tax:money sr_return_amt_inc_tax:money sr_fee:money
    sr_return_ship_cost:money sr_refunded_cash:money sr_reversed_charge:money
    sr_store_credit:money sr_net_loss:money
    created_at:instant updated_at:instant
""")

# The narrower shapes that the analytics jobs declare over the same topics.
SALES_EVENT = columns("""
    id:long ss_sold_date_sk:int ss_sold_time_sk:int ss_item_sk:int ss_customer_sk:int
    ss_store_sk:int ss_ticket_number:long ss_quantity:int ss_sales_price:money
    ss_ext_sales_price:money ss_net_paid:money ss_net_profit:money created_at:instant
""")

RETURN_EVENT = columns("""
    id:long sr_returned_date_sk:int sr_return_time_sk:int sr_item_sk:int sr_customer_sk:int
    sr_store_sk:int sr_ticket_number:long sr_return_quantity:int sr_return_amt:money
    sr_net_loss:money created_at:instant
""")

AUDIT_COLUMNS = ["created_at", "updated_at"]
SOURCE_KEY = "id"
TARGET_KEY = "source_id"
SYNC_COLUMN = "sync_timestamp"

STORE_DIM = columns("s_store_sk:int s_store_name:string s_state:string s_market_manager:string")
DATE_DIM = columns("d_date_sk:int d_date:date")


def warehouse_schema(source: T.StructType) -> T.StructType:
    """The keyed target of a source table: key renamed, audit columns out, load stamp in."""
    payload = [f for f in source.fields if f.name not in [SOURCE_KEY, *AUDIT_COLUMNS]]
    return T.StructType([
        T.StructField(TARGET_KEY, T.LongType(), False), *payload,
        T.StructField(SYNC_COLUMN, T.TimestampType()),
    ])


def envelope_schema(row: T.StructType) -> T.StructType:
    """A change record: kind, order, time, origin, and the row before and after the change."""
    return T.StructType([
        T.StructField("op", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("op_ts", T.TimestampType()),
        T.StructField("db_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("before", row),
        T.StructField("after", row),
    ])
