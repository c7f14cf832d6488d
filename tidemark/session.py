"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window state lives off-heap on the executors and is checkpointed as change logs, so it
    # may outgrow the JVM heap and survives the loss of an executor.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}

_private_dirs: dict[str, str] = {}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; cluster sizing stays with spark-submit.

    ``conf`` takes option names with ``__`` for ``.``, e.g. ``spark__driver__memory="8g"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def pin_time_zone(spark: SparkSession, zone: str = "UTC") -> None:
    """Casts between instants and zone-less times depend on this setting, so jobs set it explicitly.

    Windows do not: they start at whole multiples of their size since 1970 in UTC. For days of
    another zone, pass zone-less local times (``to_zone``) as the event time of a batch.
    """
    spark.conf.set("spark.sql.session.timeZone", zone)


def work_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables: ``spark.checkpoint.dir``.

    Every executor must reach it. Only a local session may fall back to a private folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _private_dirs:
        _private_dirs[context.applicationId] = tempfile.mkdtemp(prefix="run-tidemark-")
    return _private_dirs[context.applicationId]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path below the working folder that nothing has used before (not created yet)."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
