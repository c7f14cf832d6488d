"""Look-ups of many keys in a large table, with scans that skip what cannot hold them."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

# Ranges of the first key that are handed to the scan.
RANGES = 64
# Wanted keys up to this size are broadcast; more are joined with a shuffle.
BROADCAST_BYTES = 64 * 2**20
# What a key takes besides its text.
KEY_OVERHEAD = 32


def key_ranges(wanted: DataFrame, key: str, most: int = RANGES) -> list[tuple]:
    """At most ``most`` closed ranges of a number or time that hold all its wanted values, NULL aside.

    The values are counted into cells of equal width, and each occupied cell into parts of equal width
    between its own ends, so a value far from all others does no harm. A bounded number of parts
    reaches the driver, and they are joined across the narrowest gaps. Any other kind of key gives one range.
    """
    ends = wanted.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    if ends.low is None:
        return []
    if wanted.schema[key].dataType.typeName() not in ("long", "integer", "short", "byte") or ends.low == ends.high:
        return [(ends.low, ends.high)]
    low, high = F.min(key).alias("low"), F.max(key).alias("high")

    def place(start, width):
        # In doubles, which no key overflows; rounding moves a value to a neighbouring part at most.
        return F.floor((F.col(key).cast("double") - start.cast("double")) / width)

    known = wanted.filter(F.col(key).isNotNull()).select(
        key, place(F.lit(ends.low), max(1.0, (ends.high - ends.low + 1) / (8 * most))).alias("_cell"))
    cells = known.groupBy("_cell").agg(low, high)
    inner = F.greatest(F.lit(1.0), (F.col("high").cast("double") - F.col("low").cast("double") + 1) / 16)
    parts = known.join(F.broadcast(cells), "_cell").groupBy("_cell", place(F.col("low"), inner).alias("_part")).agg(low, high)
    runs = sorted([r.low, r.high] for r in parts.collect())
    gaps = sorted(range(1, len(runs)), key=lambda i: runs[i][0] - runs[i - 1][1])
    joined = set(gaps[:max(0, len(runs) - most)])
    kept: list[list] = []
    for i, run in enumerate(runs):
        if i in joined:
            kept[-1][1] = run[1]
        else:
            kept.append(run)
    return [(a, b) for a, b in kept]


def in_ranges(key: str, ranges: list[tuple]) -> Column:
    """A filter that reaches the scan: files, row groups and pages outside the ranges are not read."""
    column = F.col(key)
    return reduce(or_, [column == a if a == b else (column >= a) & (column <= b) for a, b in ranges], F.lit(False))


def key_bytes(keys: list[str]) -> Column:
    text = F.concat_ws("", *[F.col(k).cast("string") for k in keys])
    return (F.octet_length(text) + KEY_OVERHEAD * len(keys)).cast("long")


def rows_of_keys(table: DataFrame, wanted: DataFrame, keys: list[str], most: int = RANGES,
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of a table whose keys are wanted; NULL keys match nothing.

    What the look-up costs follows from where the wanted keys lie. In a table that is sorted by the
    first key (``sinks.write_by_key``), keys that lie together, like those of recent orders, read a few
    pages; keys spread evenly over the whole table read most of it, but still shuffle none of it
    while they are small. The wanted side is read twice before, for its ranges and its size.
    """
    wanted = wanted.select(*keys).dropna().distinct()
    size = wanted.agg(F.coalesce(F.sum(key_bytes(keys)), F.lit(0))).first()[0]
    found = table.filter(in_ranges(keys[0], key_ranges(wanted, keys[0], most)))
    other = wanted.select(*[F.col(k).alias(f"_wanted_{k}") for k in keys])
    same = reduce(and_, [F.col(k) == F.col(f"_wanted_{k}") for k in keys])
    return found.join(F.broadcast(other) if size <= broadcast_bytes else other, same, "left_semi")
