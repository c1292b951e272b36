"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_local_dirs: dict[str, tempfile.TemporaryDirectory] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on: event times are UTC, repeated JSON keys keep the last value."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def build(master: str | None = None, name: str = "bidtide", **settings: str) -> SparkSession:
    """A session for these jobs: adaptive execution with skew handling, RocksDB state, and no call-site capture,
    which costs several round trips to the JVM per column expression."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare((builder.master(master) if master else builder).getOrCreate())


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; only a local session may fall back to a temporary one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.TemporaryDirectory(prefix="bidtide-", ignore_cleanup_errors=True)
    return _local_dirs[app].name


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder. All paths of one application share a folder, which can be removed
    once the application has ended."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later passes neither recompute it nor
    depend on the executors that produced it."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stream_session(spark: SparkSession) -> SparkSession:
    """A sibling session for streaming queries, with RocksDB state. Stores don't count their rows, as that looks up every key they write;
    ``numRowsTotal`` of a query's progress has no meaning.

    Stateful queries freeze ``spark.sql.shuffle.partitions`` in their checkpoint, so a cluster keeps its
    configured value; a local run uses one state partition per core.
    """
    session = prepare(spark.newSession())
    session.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    session.conf.set("spark.sql.streaming.join.stateFormatVersion", "3")
    if _is_local(spark):
        session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    else:
        session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return session
