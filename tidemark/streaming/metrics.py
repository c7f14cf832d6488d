"""What running queries report about themselves, as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

BATCH = ("batch_id long, rows_in long, watermark string, late_groups long, state_rows long,"
         " state_updates long, observed map<string, map<string, long>>")


def batches(query: StreamingQuery) -> list[dict]:
    """One record for each batch that the query still remembers (``numRecentProgressUpdates``).

    ``late_groups`` are the groups whose rows came for windows that were closed: a window and key that
    is dropped counts once in a batch, however many rows it merged. ``observed`` has the metrics that
    ``DataFrame.observe`` named. Batches without data, which only close windows, are records too.
    """
    out = []
    for p in query.recentProgress:
        state = p["stateOperators"]
        out.append({
            "batch_id": p["batchId"], "rows_in": sum(s["numInputRows"] for s in p["sources"]),
            "watermark": p["eventTime"].get("watermark") if p.get("eventTime") else None,
            "late_groups": sum(s["numRowsDroppedByWatermark"] for s in state),
            "state_rows": sum(s["numRowsTotal"] for s in state),
            "state_updates": sum(s["numRowsUpdated"] for s in state),
            "observed": {name: {k: v for k, v in row.asDict().items() if isinstance(v, int)}
                         for name, row in p["observedMetrics"].items()},
        })
    return out


def batch_rows(spark: SparkSession, records: list[dict]) -> DataFrame:
    """The records as a table: a row for each batch."""
    return spark.createDataFrame(
        [tuple(r[f] for f in ("batch_id", "rows_in", "watermark", "late_groups", "state_rows", "state_updates", "observed")) for r in records], BATCH)


def open_groups(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The groups that a stopped query holds open: ``key`` and ``value`` as its state keeps them."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint).select("key", "value")


def total_open(spark: SparkSession, checkpoint: str, value: Column, operator: int = 0) -> int:
    """A sum over the groups that are open: one number."""
    return open_groups(spark, checkpoint, operator).agg(F.coalesce(F.sum(value), F.lit(0)).cast("long")).first()[0]
