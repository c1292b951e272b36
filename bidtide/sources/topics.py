"""Topics of JSON or text messages, from Kafka or from a folder of text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidtide.functions.times import SERVING_TIME_FORMAT, from_millis

# Fixed value: events may arrive up to 5 s out of order.
OUT_OF_ORDER_MS = 5000
OUT_OF_ORDER = f"{OUT_OF_ORDER_MS // 1000} seconds"


class KafkaUnavailable(RuntimeError):
    """The session has no Kafka connector on its classpath."""


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    max_offsets_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Stream the key and value of a Kafka topic as text, from the ``latest`` or ``earliest`` offset."""
    if starting not in ("latest", "earliest"):
        raise ValueError("starting must be 'latest' or 'earliest'")
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**(options or {}))
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    try:
        raw = reader.load()
    except Exception as error:
        if "Failed to find data source: kafka" in str(error) or "DATA_SOURCE_NOT_FOUND" in str(error):
            raise KafkaUnavailable("start Spark with the spark-sql-kafka package to read topics") from error
        raise
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "offset", "partition", "timestamp")


def file_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the lines of the text files that appear in a folder, oldest file first."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def file_upserts(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream keyed messages from a folder of text files, in the columns of a Kafka topic: one JSON object a line with the texts
    ``key`` and ``value`` (null: delete), ``timestamp`` in epoch milliseconds and ``offset``."""
    envelope = "key STRING, value STRING, timestamp BIGINT, offset BIGINT"
    lines = file_messages(spark, path, max_files_per_trigger)
    messages = lines.select(F.from_json("value", envelope, {"mode": "FAILFAST"}).alias("m")).select("m.*")
    return messages.withColumn("timestamp", from_millis("timestamp"))


def as_upsert_lines(messages: DataFrame) -> DataFrame:
    """Keyed messages (key, value, timestamp, offset) as the lines that ``file_upserts`` reads."""
    return messages.select(F.to_json(F.struct("key", "value", F.unix_millis("timestamp").alias("timestamp"), "offset")).alias("value"))


def decode(messages: DataFrame, schema: T.StructType, on_error: str = "fail") -> DataFrame:
    """JSON values as columns of ``schema``. A malformed message fails the query, or is dropped with
    ``on_error="drop"``; a null one is skipped. A consumer names only the fields it needs."""
    corrupt = "__corrupt"
    fields = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    options = {"columnNameOfCorruptRecord": corrupt, "timestampFormat": SERVING_TIME_FORMAT}
    rows = messages.where(F.col("value").isNotNull()).select(F.from_json("value", fields, options).alias("r")).select("r.*")
    if on_error == "drop":
        return rows.where(F.col(corrupt).isNull()).drop(corrupt)
    checked = F.when(
        F.col(corrupt).isNotNull(), F.raise_error(F.concat(F.lit("malformed message: "), F.col(corrupt)))
    )
    # The check must survive column pruning, so it is a filter rather than a column.
    return rows.where(F.coalesce(checked.cast("boolean"), F.lit(True))).drop(corrupt)


def decode_upserts(messages: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """Rows of an upsert topic: the key from the JSON key, the other columns from the JSON value, and ``deleted``
    where the value is null. Other columns of the messages, such as the offset, are kept to order versions."""
    options = {"mode": "FAILFAST", "timestampFormat": SERVING_TIME_FORMAT}
    key_type = T.StructType([schema[key]])
    rest = T.StructType([f for f in schema.fields if f.name != key])
    extra = [c for c in messages.columns if c not in ("key", "value")]
    parsed = messages.select(
        F.from_json("key", key_type, options).alias("k"),
        F.from_json("value", rest, options).alias("v"),
        F.col("value").isNull().alias("deleted"),
        *extra,
    )
    return parsed.select("k.*", "v.*", "deleted", *extra)


def profile_versions(messages: DataFrame, schema: T.StructType, key: str, version_time: str) -> DataFrame:
    """The versions that an upsert topic describes: inserts and replacements by their own ``version_time``, and for each null
    value a closing version (``deleted``) at its message's timestamp. Messages without a key are left out."""
    rows = decode_upserts(messages, schema, key).where(F.col(key).isNotNull())
    when = F.when(F.col("deleted"), F.col("timestamp")).otherwise(F.col(version_time))
    return rows.withColumn(version_time, when).select(*schema.names, "deleted", "offset")


def with_event_time(
    rows: DataFrame, time: str = "ts", source: Column | None = None, delay: str | None = OUT_OF_ORDER
) -> DataFrame:
    """Add the event time (by default from ``timestamp_ts``) and its watermark."""
    timed = rows
    if source is not None or time not in rows.columns:
        timed = rows.withColumn(time, from_millis("timestamp_ts") if source is None else source)
    return timed.withWatermark(time, delay) if delay else timed
