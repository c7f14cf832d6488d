"""Projections between the source, event and warehouse shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.temporal import change_time
from ..schemas import AUDIT_COLUMNS, SOURCE_KEY, SYNC_COLUMN, TARGET_KEY

# Fixed value: the tag on published events.
EVENT_SOURCE = "CDC-TO-KAFKA-TIMESTAMP-FIXED"


# The names under which the window operators take the columns of the event topics.
SALES_NAMES = {"ss_store_sk": "store_sk", "ss_item_sk": "item_sk", "ss_ext_sales_price": "ext_sales_price",
               "ss_net_profit": "net_profit"}
RETURN_NAMES = {"sr_store_sk": "store_sk", "sr_item_sk": "item_sk", "sr_return_amt": "return_amt",
                "sr_net_loss": "net_loss"}


def as_sales(events: DataFrame) -> DataFrame:
    return events.withColumnsRenamed(SALES_NAMES)


def as_returns(events: DataFrame) -> DataFrame:
    return events.withColumnsRenamed(RETURN_NAMES)


def to_warehouse(df: DataFrame, loaded_at: Column | None = None, keyed: bool = True) -> DataFrame:
    """Audit columns out, load stamp in; the key is renamed, or dropped for unkeyed targets."""
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    plain = df.drop(*AUDIT_COLUMNS)
    plain = plain.withColumnRenamed(SOURCE_KEY, TARGET_KEY) if keyed else plain.drop(SOURCE_KEY)
    return plain.withColumn(SYNC_COLUMN, stamp)


def to_sales_event(changes: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """The published event of a sale: short names, kind of change, repaired event time."""
    now = F.current_timestamp() if loaded_at is None else loaded_at
    return changes.select(
        F.col("id").alias("sales_id"),
        F.col("op").alias("event_type"),
        change_time(F.col("op_ts"), F.col("updated_at"), now).alias("event_time"),
        F.col("created_at").alias("created_time"),
        F.col("updated_at").alias("updated_time"),
        F.col("ss_ticket_number").alias("ticket_number"),
        F.col("ss_item_sk").alias("item_sk"),
        F.col("ss_customer_sk").alias("customer_sk"),
        F.col("ss_store_sk").alias("store_sk"),
        F.col("ss_quantity").alias("quantity"),
        F.col("ss_sales_price").alias("sales_price"),
        F.col("ss_ext_sales_price").alias("ext_sales_price"),
        F.col("ss_net_profit").alias("net_profit"),
        F.lit(EVENT_SOURCE).alias("event_source"),
    )


def sales_monitor(changes: DataFrame) -> DataFrame:
    """What a person watching the sales feed wants to see."""
    return changes.select(
        F.col("op").alias("op_type"), F.col("op_ts").alias("op_time"), "id",
        F.col("ss_ticket_number").alias("ticket_number"), F.col("ss_item_sk").alias("item_sk"),
        F.col("ss_customer_sk").alias("customer_sk"), F.col("ss_quantity").alias("quantity"),
        F.col("ss_sales_price").alias("sales_price"),
        F.col("ss_ext_sales_price").alias("ext_sales_price"),
        F.col("ss_net_profit").alias("net_profit"),
    )


def returns_monitor(changes: DataFrame) -> DataFrame:
    return changes.select(
        F.col("op").alias("op_type"), F.col("op_ts").alias("op_time"), "id",
        F.col("sr_ticket_number").alias("ticket_number"), F.col("sr_item_sk").alias("item_sk"),
        F.col("sr_customer_sk").alias("customer_sk"),
        F.col("sr_return_quantity").alias("return_quantity"),
        F.col("sr_return_amt").alias("return_amt"), F.col("sr_net_loss").alias("net_loss"),
    )
