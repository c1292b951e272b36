"""Append sinks: JSON or text messages to Kafka or files, rows to a Parquet table, status rows to the console."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from bidtide.functions.times import SERVING_TIME_FORMAT

_JSON = {"timestampFormat": SERVING_TIME_FORMAT, "ignoreNullFields": "false"}


def as_messages(rows: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Rows as JSON ``value`` messages with explicit nulls, and the key columns as a JSON ``key``."""
    value = F.to_json(F.struct(*rows.columns), _JSON).alias("value")
    if not key:
        return rows.select(value)
    return rows.select(F.to_json(F.struct(*key), _JSON).alias("key"), value)


def _writer(
    rows: DataFrame, checkpoint: str, once: bool, trigger: str | None, mode: str = "append"
) -> DataStreamWriter:
    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if once:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger) if trigger else writer


def to_files(
    messages: DataFrame, path: str, checkpoint: str, once: bool = False, trigger: str | None = None
) -> DataStreamWriter:
    """Write the ``value`` of each message as a line of text."""
    return _writer(messages.select("value"), checkpoint, once, trigger).format("text").option("path", path)


def to_kafka(
    messages: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    once: bool = False,
    trigger: str | None = None,
    mode: str = "append",
) -> DataStreamWriter:
    """Write keyed or plain messages to Kafka. Keyed messages of an aggregation in ``update`` mode make the topic
    an upsert topic: the last message of a key is its current row."""
    writer = _writer(messages, checkpoint, once, trigger, mode).format("kafka")
    return writer.option("kafka.bootstrap.servers", servers).option("topic", topic)


def to_table(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    once: bool = False,
    trigger: str | None = None,
) -> DataStreamWriter:
    """Append rows to a Parquet table, optionally partitioned (for instance by event date)."""
    writer = _writer(rows, checkpoint, once, trigger).format("parquet").option("path", path)
    return writer.partitionBy(*partition_by) if partition_by else writer


def to_console(rows: DataFrame, checkpoint: str, once: bool = False) -> DataStreamWriter:
    return _writer(rows, checkpoint, once, None).format("console").option("truncate", "false")
