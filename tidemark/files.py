"""Small control files and listings on whatever file system the path names; empty tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def _path(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle, handle.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    handle, fs = _path(spark, path)
    return fs.exists(handle)


def is_dir(spark: SparkSession, path: str) -> bool:
    handle, fs = _path(spark, path)
    return fs.exists(handle) and fs.getFileStatus(handle).isDirectory()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when the folder does not exist."""
    handle, fs = _path(spark, path)
    if not fs.exists(handle):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(handle))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    handle, fs = _path(spark, path)
    return fs.getContentSummary(handle).getLength()


def modified(spark: SparkSession, path: str) -> dict[str, int]:
    """Name and time, in milliseconds, of each file directly below a folder."""
    handle, fs = _path(spark, path)
    if not fs.exists(handle):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(handle) if s.isFile()}


def delete(spark: SparkSession, path: str) -> None:
    handle, fs = _path(spark, path)
    fs.delete(handle, True)


def read_text(spark: SparkSession, path: str) -> str:
    handle, fs = _path(spark, path)
    stream = fs.open(handle)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that readers see whole or not at all, and never replace one."""
    target, fs = _path(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    draft, _ = _path(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if not fs.rename(draft, target):
        fs.delete(draft, False)
        raise FileExistsError(path)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, in a form that Spark knows to be empty and drops from joins and unions."""
    nothing = spark.range(1).filter(F.lit(False))
    return nothing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
