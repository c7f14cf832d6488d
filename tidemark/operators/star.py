"""The daily store view: sales by store and day with the store's attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The fact columns the view needs.
FACT_COLUMNS = ["ss_store_sk", "ss_sold_date_sk", "ss_net_paid_inc_tax", "ss_net_profit",
                "ss_quantity", "ss_ticket_number"]
SUM_KEYS = ["ss_store_sk", "ss_sold_date_sk"]
# Measure of the view -> fact column it sums.
MEASURES = {"total_sales_amount": "ss_net_paid_inc_tax", "total_net_profit": "ss_net_profit",
            "total_items_sold": "ss_quantity"}
COUNTED = "ss_ticket_number"
# Dimensions up to this size are sent to every executor.
BROADCAST_BYTES = 64 * 2**20


def star_join(fact: DataFrame, date_dim: DataFrame, store: DataFrame) -> DataFrame:
    """Fact rows with their day and store attributes; rows without a match drop out.

    Dimensions that are measured to be small are broadcast, so facts are not shuffled and a store
    with a third of them does no harm; larger ones are joined as Spark sees fit.
    """
    return (
        fact.join(measured(date_dim), F.col("ss_sold_date_sk") == F.col("d_date_sk"))
        .join(measured(store), F.col("ss_store_sk") == F.col("s_store_sk"))
    )


def measured(dimension: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A dimension, marked for broadcast if its rows are measured to stay below ``limit`` bytes.

    The estimate of a joined dimension is a product of its parts and tells nothing, so one job
    counts the rows and adds up the bytes of what has no fixed width.
    """
    fields = dimension.schema.fields
    loose = [f.name for f in fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for f in fields):
        return dimension  # no cheap measure: Spark's own checks decide
    texts = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)).cast("long") for c in loose), F.lit(0).cast("long"))
    # Rows in memory: a header, eight bytes a column, and the texts; twice that in a hash table.
    row = F.lit(16 + 8 * len(fields)).cast("long") + texts
    size = dimension.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]
    return F.broadcast(dimension) if 2 * size <= limit else dimension


def fact_sums(fact: DataFrame, taken_out: Column | None = None) -> DataFrame:
    """Sums per store and date key; rows where ``taken_out`` holds count negatively.

    Next to each sum goes the count of known values, which tells a sum of nothing (NULL) from
    a sum that came out as zero. Sums of this kind add up: the sums of a table plus those of its
    changes are the sums of the changed table.
    """
    def signed(value: Column) -> Column:
        # Negation keeps the type; multiplying by a sign would widen decimals.
        return value if taken_out is None else F.when(taken_out, -value).otherwise(value)

    one = signed(F.lit(1))
    sums = [F.sum(one).alias("n_rows")]
    for measure, column in MEASURES.items():
        sums += [F.sum(signed(F.col(column))).alias(measure),
                 F.sum(F.when(F.col(column).isNotNull(), one).otherwise(0)).alias(f"known_{measure}")]
    sums.append(F.sum(F.when(F.col(COUNTED).isNotNull(), one).otherwise(0)).alias("transaction_count"))
    known_keys = F.col("ss_store_sk").isNotNull() & F.col("ss_sold_date_sk").isNotNull()
    return fact.filter(known_keys).groupBy(*SUM_KEYS).agg(*sums)


def add_up(sums: DataFrame, keys: list[str] = SUM_KEYS) -> DataFrame:
    """Merge partial sums; the result has the same columns and types."""
    fields = [c for c in sums.columns if c not in keys]
    return sums.groupBy(*keys).agg(
        *[F.sum(c).cast(sums.schema[c].dataType).alias(c) for c in fields]
    )


def view_of_sums(sums: DataFrame, date_dim: DataFrame, store: DataFrame) -> DataFrame:
    """Attach the dimensions to sums per store and date key.

    Joining after the summing is the same query, as a fact row joins by these two keys alone,
    but the joins see one row per store and day instead of every sale. A store that makes up
    a third of the sales then is a few rows, not a skewed join.
    """
    keys = ["ss_store_sk", "s_store_name", "s_state", "s_market_manager", "d_date"]
    counts = ["n_rows", *MEASURES, *[f"known_{m}" for m in MEASURES], "transaction_count"]
    joined = star_join(sums, date_dim, store).select(*keys, *counts)
    return add_up(joined, keys).filter(F.col("n_rows") > 0).select(
        *keys[:-1], F.col("d_date").alias("sold_date_sk"),
        *[F.when(F.col(f"known_{m}") > 0, F.col(m)).alias(m) for m in MEASURES],
        "transaction_count",
    )


def daily_store_view(fact: DataFrame, date_dim: DataFrame, store: DataFrame) -> DataFrame:
    """The view, computed in full."""
    return view_of_sums(fact_sums(fact), date_dim, store)
