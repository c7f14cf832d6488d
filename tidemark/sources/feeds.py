"""Readers: change feeds, event topics, keyed topics, JDBC snapshots."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..files import empty, exists, is_dir, modified, publish_text, read_text
from ..functions.codecs import decode_keyed, decode_order, decode_rows
from ..operators.changes import kind_records, split_images
from ..operators.windows import with_event_time
from ..schemas import columns, envelope_schema
from .sinks import ORDER_HEADER

TOPIC_RECORD = columns("key:string value:string timestamp:instant offset:long order:string")
# What decides between records of a key, the weightiest first.
TOPIC_ORDER = ["record_order", "timestamp", "offset"]


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                **options: str) -> DataFrame:
    """A stream over a folder of files, or over one file (streams start from folders)."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if is_dir(spark, path):
        return reader.load(path)
    folder, _, name = path.rpartition("/")
    return reader.option("pathGlobFilter", name).load(folder)


def from_now_on(spark: SparkSession, path: str, schema: T.StructType, home: str, fmt: str = "parquet",
                **options: str) -> DataFrame:
    """A stream over a folder that leaves out what is there when it is first started.

    The first call notes in ``home`` the newest time of the files below ``path`` and which files have
    it; later calls, after a restart, go by that note. Times are the storage's own, so no two clocks
    are compared, and a file that comes within the same millisecond still counts. The time is a
    constant of each file, so the rows of older files are not read.
    """
    note = f"{home}/started.json"
    if not exists(spark, note):
        times = modified(spark, path)
        newest = max(times.values(), default=0)
        publish_text(spark, note, json.dumps({"newest": newest, "names": sorted(n for n, t in times.items() if t == newest)}))
    known = json.loads(read_text(spark, note))
    stream = file_stream(spark, path, schema, fmt, **options)
    time, newest = F.col("_metadata.file_modification_time"), F.timestamp_millis(F.lit(known["newest"]))
    later = (time > newest) | (time == newest) & ~F.col("_metadata.file_name").isin(known["names"])
    return stream.filter(later)


def kafka_options(servers: str, topic: str, start: str = "latest", **extra: str) -> dict[str, str]:
    if start not in ("latest", "earliest"):
        raise ValueError(f"start must be 'latest' or 'earliest', not {start!r}")
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start,
            **extra}


def kafka_records(spark: SparkSession, servers: str, topic: str, start: str = "latest",
                  stream: bool = True, **extra: str) -> DataFrame:
    """The records of a topic. Needs Spark's Kafka package on the class path."""
    reader = spark.readStream if stream else spark.read
    options = kafka_options(servers, topic, start, includeHeaders="true", **extra)
    return broker_records(reader.format("kafka").options(**options).load())


def broker_records(raw: DataFrame) -> DataFrame:
    """The columns of TOPIC_RECORD from a broker's: texts for bytes, the order from its header.

    All records of a key are in one partition, so the offset alone tells which came later.
    """
    order = F.filter(F.col("headers"), lambda h: h["key"] == ORDER_HEADER)
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "timestamp", "offset",
                      F.get(order, F.lit(0))["value"].cast("string").alias("order"))


def topic_records(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """The same columns from a topic kept as files, from its beginning."""
    if stream:
        return file_stream(spark, path, TOPIC_RECORD, recursiveFileLookup="true")
    return spark.read.schema(TOPIC_RECORD).option("recursiveFileLookup", "true").parquet(path)


def with_processing_time(df: DataFrame, column: str = "proc_time") -> DataFrame:
    """The time at which a row is taken in; on a stream, the start of its micro-batch."""
    return df.withColumn(column, F.current_timestamp())


def written_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches of a target kept as files, whichever streams wrote them. Spark lists only what a
    finished job left, so a batch that failed half-way has no rows."""
    if not is_dir(spark, path):
        return empty(spark, schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def event_stream(records: DataFrame, schema: T.StructType, delay: str = "5 seconds") -> DataFrame:
    """Typed events with event time and watermark from JSON records; bad rows are skipped.

    Pass a schema with only the columns in use: fields that it leaves out are not parsed.
    """
    return with_event_time(decode_rows(records, "value", schema), delay=delay)


def change_feed(records: DataFrame, row: T.StructType, text: str = "value",
                required: bool = True) -> DataFrame:
    """Changes (one row per image) with order and origin columns from JSON envelopes.

    A record that does not parse, or holds a value that its column cannot, fails the job: a
    table kept by the feed would be wrong without it. With ``required=False`` such records are
    skipped; ``codecs.unreadable`` counts them.
    """
    envelopes = decode_rows(records, text, envelope_schema(row), required=required)
    return split_images(envelopes, ["seq", "op_ts", "db_name", "table_name"])


def kind_feed(records: DataFrame, row: T.StructType, text: str = "value", kind: str = "op_type",
              required: bool = True) -> DataFrame:
    """Changes from JSON records of one image each, with its kind in the field ``kind``."""
    fields = T.StructType([T.StructField(kind, T.StringType()), *row.fields])
    return kind_records(decode_rows(records, text, fields, required=required), kind)


def keyed_changes(records: DataFrame, key_schema: T.StructType, value_schema: T.StructType,
                  order: T.StructType | None = None) -> DataFrame:
    """Changes from a keyed topic, with the columns of TOPIC_ORDER to order them by.

    ``order`` has the order columns that the writer put next to each record, also to those without
    a value: an older change that arrives later then loses, as it does in a keyed table. Without
    it, or in records that carry none, ``record_order`` is NULL and the record's time decides, then
    its offset.
    """
    none = T.StructType([T.StructField("none", T.StringType())])
    known = decode_order("order", order) if order else F.lit(None).cast(none)
    return decode_keyed(records.withColumn("record_order", known), key_schema, value_schema, keep=TOPIC_ORDER)


def jdbc_snapshot_options(url: str, table: str, key: str, lower: int, upper: int,
                          chunk_rows: int = 8192, ranges: int | None = None) -> dict[str, str]:
    """Read options that split a table into ``ranges`` key ranges.

    By default a range has about ``chunk_rows`` keys, or more if that would take over 10,000
    ranges, as each is one query; the ranges cover the whole table in any case.
    """
    if upper < lower:
        raise ValueError("upper must not be below lower")
    chunks = ranges or min(-(-(upper - lower + 1) // chunk_rows), 10_000)
    return {"url": url, "dbtable": table, "partitionColumn": key, "lowerBound": str(lower),
            "upperBound": str(upper + 1), "numPartitions": str(chunks),
            "fetchsize": str(chunk_rows)}


def jdbc_snapshot(spark: SparkSession, url: str, table: str, key: str, chunk_rows: int = 8192,
                  **options: str) -> DataFrame:
    """A whole table in parallel key ranges. Asks the database for the key range first."""
    bounds = (
        spark.read.format("jdbc").options(url=url, **options)
        .option("query", f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}").load().first()
    )
    reader = spark.read.format("jdbc").options(**options)
    if bounds[0] is None:
        return reader.options(url=url, dbtable=table).load()
    return reader.options(
        **jdbc_snapshot_options(url, table, key, int(bounds[0]), int(bounds[1]), chunk_rows)
    ).load()


def json_rows(spark: SparkSession, path: str, schema: T.StructType, stream: bool = False) -> DataFrame:
    """Rows kept as JSON lines; lines that do not parse are skipped."""
    options = {"mode": "DROPMALFORMED"}
    if stream:
        return file_stream(spark, path, schema, "json", **options)
    return spark.read.schema(schema).options(**options).json(path)
