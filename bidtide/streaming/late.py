"""Rows that come too late: what a watermark drops silently, kept in a table of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from bidtide.sinks import commits
from bidtide.sinks.upsert import write_batch
from bidtide.sources.topics import OUT_OF_ORDER_MS


def _reached(spark: SparkSession, progress: str, batch_id: int) -> int | None:
    """The greatest event time (ms) of all micro-batches before one."""
    before = [folder for name, folder in commits.committed(spark, progress).items() if int(name) < batch_id]
    return spark.read.schema("ms LONG").parquet(before[-1]).first()["ms"] if before else None


def late_rows_job(
    rows: DataFrame, path: str, checkpoint: str, time: str = "ts", delay_ms: int = OUT_OF_ORDER_MS, once: bool = False
) -> DataStreamWriter:
    """Keep the rows of a stream that a stateful operator under a watermark of ``delay_ms`` drops, with ``late_ms``, how far
    behind they were.

    Operators judge a micro-batch by the watermark that the one before it ran under, which rests on the event times of the
    micro-batches before that one; so does this. Repeating a micro-batch gives the same."""
    progress = f"{checkpoint}/reached"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        judge, so_far, ms = _reached(spark, progress, batch_id - 1), _reached(spark, progress, batch_id), F.unix_millis(time)
        behind = F.lit(None if judge is None else judge - delay_ms).cast("long") - ms
        write_batch(batch.withColumn("late_ms", behind).where("late_ms >= 0"), path, batch_id)
        furthest = batch.agg(F.greatest(F.max(ms), F.lit(so_far).cast("long")).alias("ms")).where("ms IS NOT NULL")
        commits.commit(furthest.coalesce(1), progress, f"{batch_id:012d}")

    writer = rows.writeStream.outputMode("append").option("checkpointLocation", f"{checkpoint}/progress").foreachBatch(write)
    return writer.trigger(availableNow=True) if once else writer
