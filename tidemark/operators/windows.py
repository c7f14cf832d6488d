"""Event-time window metrics.

Each function takes sales or returns events (batch or stream) and returns one row per window
and key. Window sizes and thresholds are parameters; the defaults are the model's fixed values.
A stream has to carry its watermark already, see ``with_event_time``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.temporal import hop, tumble

# Watermark, window sizes, thresholds and texts of the model.
OUT_OF_ORDER = "5 seconds"
METRIC_WINDOW = "1 minute"
ALERT_WINDOW = "5 minutes"
TREND_WINDOW, TREND_SLIDE = "5 minutes", "1 minute"
PSEUDO_RATE_BASE = 100
ALERT_MIN_RETURNS, ALERT_RATE_BASE, ALERT_RATE = 10, 50, "0.15"
HOT_ABOVE, NORMAL_ABOVE, TREND_MIN_SALES = 10, 5, 1
ALERT_TYPE = "HIGH_RETURN_RATE"
ALERT_TEXT = ("商店 ", " 退货率异常：", "%")
TRENDS = ("HOT", "NORMAL", "COLD")


def with_event_time(df: DataFrame, source: str = "created_at", column: str = "event_time",
                    delay: str = OUT_OF_ORDER) -> DataFrame:
    """Add the event-time column and, on a stream, the watermark that trails it.

    Watermarks need an instant, so zone-less times are read in the session's zone.
    """
    timed = df.withColumn(column, F.col(source).cast("timestamp"))
    return timed.withWatermark(column, delay) if df.isStreaming else timed


def arrival_order(event_time: str, tie_break: str) -> Column:
    """Event time, then id, as one ordered number.

    A struct would order the same way but cannot sit in a hash aggregation buffer, which would
    turn the whole aggregation into one that sorts its input. A wide decimal can.
    """
    micros = F.unix_micros(event_time).cast("decimal(18,0)")
    offset_id = F.col(tie_break).cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")
    return micros * F.lit("20000000000000000000").cast("decimal(20,0)") + offset_id


def first_by_time(value: str, event_time: str = "event_time", tie_break: str = "id") -> Column:
    """The first known value by event time; rows where it is NULL do not count."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), arrival_order(event_time, tie_break)))


def _bounds(window: str = "window") -> list[Column]:
    """Half-open window bounds as ordinary columns."""
    return [F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end")]


def sales_metrics(sales: DataFrame, size: str = METRIC_WINDOW) -> DataFrame:
    """Sales per window and store: count, revenue, profit, average, first item sold.

    Sums keep Spark's wide decimals rather than a ten-digit column, which a busy store would
    overflow. Partial sums leave each map task, so a dominant store is not a hot spot.
    """
    return (
        sales.filter(F.col("store_sk").isNotNull())
        .groupBy(tumble("event_time", size=size), "store_sk")
        .agg(
            F.count("*").alias("total_sales"),
            F.sum("ext_sales_price").alias("total_revenue"),
            F.sum("net_profit").alias("total_profit"),
            F.avg("ext_sales_price").cast("decimal(18,2)").alias("avg_order_value"),
            first_by_time("item_sk").alias("first_item_sk"),
        )
        .select(*_bounds(), "store_sk", "total_sales", "total_revenue", "total_profit",
                "avg_order_value", "first_item_sk")
    )


def sales_counts(sales: DataFrame, size: str = METRIC_WINDOW) -> DataFrame:
    """Sales per window and store, counted only."""
    return (
        sales.filter(F.col("store_sk").isNotNull())
        .groupBy(tumble("event_time", size=size), "store_sk").agg(F.count("*").alias("total_sales"))
        .select(*_bounds(), "store_sk", "total_sales")
    )


def return_metrics(returns: DataFrame, size: str = METRIC_WINDOW) -> DataFrame:
    """Returns per window and store. The rate is the count over a fixed base, hence pseudo;
    ``true_return_rate`` relates returns to sales."""
    return (
        returns.filter(F.col("store_sk").isNotNull())
        .groupBy(tumble("event_time", size=size), "store_sk")
        .agg(
            F.count("*").alias("total_returns"),
            F.sum("return_amt").alias("total_return_amount"),
            F.sum("net_loss").alias("total_loss"),
        )
        .select(*_bounds(), "store_sk", "total_returns", "total_return_amount", "total_loss",
                (F.col("total_returns").cast("decimal(18,4)") / F.lit(PSEUDO_RATE_BASE))
                .cast("decimal(18,4)").alias("pseudo_return_rate"))
    )


def return_alerts(returns: DataFrame, size: str = ALERT_WINDOW,
                  min_returns: int = ALERT_MIN_RETURNS, rate_base: int = ALERT_RATE_BASE,
                  threshold: str = ALERT_RATE) -> DataFrame:
    """One alert per window and store whose rate passes the threshold.

    The count is cast to decimal(18,4): a five-digit decimal, as first declared, cannot hold
    any count that is large enough to alert.
    """
    before, middle, after = ALERT_TEXT
    rate = F.when(
        F.col("return_count") > min_returns,
        (F.col("return_count").cast("decimal(18,4)") / F.lit(rate_base)).cast("decimal(18,8)"),
    ).otherwise(F.lit(0).cast("decimal(18,8)"))
    percent = F.col("return_rate") * F.lit(100)
    return (
        returns.filter(F.col("store_sk").isNotNull())
        .groupBy(tumble("event_time", size=size), "store_sk")
        .agg(F.count("*").alias("return_count"))
        .withColumn("return_rate", rate)
        .filter(F.col("return_rate") > F.lit(threshold).cast("decimal(5,4)"))
        .select(
            F.col("window.end").alias("alert_time"),
            F.lit(ALERT_TYPE).alias("alert_type"),
            "store_sk",
            F.concat(F.lit(before), F.col("store_sk").cast("string"), F.lit(middle),
                     percent.cast("string"), F.lit(after)).alias("message"),
            percent.cast("decimal(18,2)").alias("value"),
        )
    )


def _seconds(duration: str) -> int | None:
    """Length of a plain duration like '5 minutes'; None for anything else."""
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    number, _, unit = duration.partition(" ")
    unit = unit.rstrip("s")
    return int(number) * units[unit] if number.isdigit() and unit in units else None


def hopping_sums(df: DataFrame, key: str, sums: dict[str, Column | None], size: str,
                 slide: str, chained: bool = False) -> DataFrame:
    """Counts (``None``) and sums per overlapping window and key.

    Assigning each row to all its windows multiplies the input by size/slide before anything
    is aggregated. When the slide divides the size, the rows of one slide share all their
    windows, so batch input is first reduced to one row per slide and key, and only those are
    multiplied. A stream keeps the direct form unless it is ``chained``.

    Chained, a stream has two stateful steps: the first sums each open slide, and gives it out when
    the watermark has passed the slide; the second spreads closed slides over their windows. The
    windows are held as in the direct form, and close as they do there, but a batch updates one
    slide for a row instead of size/slide windows, and each slide updates its windows once. Rows
    that are late for their slide do not count for its open windows.
    """
    first = [(F.count("*") if c is None else F.sum(c)).alias(n) for n, c in sums.items()]
    length, step = _seconds(size), _seconds(slide)
    whole = length and step and length % step == 0 and length != step
    if chained and df.isStreaming and not whole:
        raise ValueError(f"cannot chain windows of {size} by {slide}")
    if not whole or df.isStreaming and not chained:
        return df.groupBy(hop("event_time", size=size, slide=slide), key).agg(*first)
    slides = df.groupBy(tumble("event_time", size=slide).alias("_slide"), key).agg(*first)
    # window_time carries the watermark on to the second step.
    begin = F.window_time("_slide") if df.isStreaming else F.col("_slide.start")
    slides = slides.select(begin.alias("_at"), key, *sums)
    return slides.groupBy(hop("_at", size=size, slide=slide), key).agg(*[F.sum(n).alias(n) for n in sums])


def item_trends(sales: DataFrame, size: str = TREND_WINDOW, slide: str = TREND_SLIDE,
                hot_above: int = HOT_ABOVE, normal_above: int = NORMAL_ABOVE,
                min_sales: int = TREND_MIN_SALES, chained: bool = False) -> DataFrame:
    """Items per overlapping window with more than ``min_sales`` sales, graded by count."""
    hot, normal, cold = TRENDS
    sold = F.col("sales_count")
    return (
        hopping_sums(sales.filter(F.col("item_sk").isNotNull()), "item_sk",
                     {"sales_count": None, "revenue": F.col("ext_sales_price")}, size, slide, chained)
        .filter(sold > min_sales)
        .select(*_bounds(), "item_sk", "sales_count", "revenue",
                F.when(sold > hot_above, hot).when(sold > normal_above, normal)
                .otherwise(cold).alias("trend_direction"))
    )


def top_items(sales: DataFrame, size: str = METRIC_WINDOW) -> DataFrame:
    """The best-selling item per window and store; the smaller item number wins a tie.

    Counting per item first spreads a dominant store over its items, and the second step
    only sees one row per item.
    """
    per_item = (
        sales.filter(F.col("store_sk").isNotNull() & F.col("item_sk").isNotNull())
        .groupBy(tumble("event_time", size=size), "store_sk", "item_sk")
        .agg(F.count("*").alias("item_sales"))
    )
    # Count descending, then item ascending, as one ordered number (see arrival_order).
    rank = (F.col("item_sales").cast("decimal(18,0)") * F.lit("20000000000000000000").cast("decimal(20,0)")
            - F.col("item_sk").cast("decimal(20,0)"))
    return (
        per_item.groupBy("window", "store_sk")
        .agg(F.max_by("item_sk", rank).alias("top_item_sk"),
             F.max("item_sales").alias("top_item_sales"))
        .select(*_bounds(), "store_sk", "top_item_sk", "top_item_sales")
    )


def true_return_rate(sales: DataFrame, returns: DataFrame, size: str = METRIC_WINDOW) -> DataFrame:
    """Returns over sales per window and store; no rate where nothing was sold.

    Both sides are counted in one grouping over their union, so no join is needed and each
    side is reduced before it is shuffled.
    """
    sold = sales.select("event_time", "store_sk", F.lit(1).alias("_sold"), F.lit(0).alias("_back"))
    back = returns.select("event_time", "store_sk", F.lit(0).alias("_sold"), F.lit(1).alias("_back"))
    return (
        sold.unionByName(back).filter(F.col("store_sk").isNotNull())
        .groupBy(tumble("event_time", size=size), "store_sk")
        .agg(F.sum("_sold").alias("total_sales"), F.sum("_back").alias("total_returns"))
        .select(*_bounds(), "store_sk", "total_sales", "total_returns",
                F.when(F.col("total_sales") > 0,
                       F.col("total_returns") / F.col("total_sales")).alias("return_rate"))
    )
